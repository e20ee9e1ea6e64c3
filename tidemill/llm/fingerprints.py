"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by deterministic coin tossing: runs of one symbol become one unit, so neighbours differ; a
unit's label is the lowest bit in which it differs from its left neighbour, with that bit; repeated a few times, labels
are below 6 and neighbours still differ; phrases begin at local maxima, at most eleven units apart. A phrase's name is a
hash of its units, and the names are the next level's symbols. Where a phrase begins depends on a few symbols around it
only, so equal substrings are cut alike away from their ends, wherever they stand.

The fingerprint keeps, for each of ``SLOTS`` classes of names, 16 bits of the least name: ``LOW_SLOTS`` classes are of
level 1, the others of levels 2 and up, for texts of any length. The likeness of two fingerprints is the share of equal slots
among those used.

Scale: texts are dealt once by ranges of doc_id, sorted, and read as a stream; each meets the next one there. The ends of
ranges (two rows per partition) are ranked and paired by joins afterwards.

Defined results: a null text counts as empty; empty texts have the fingerprint without names, like only to itself; order is
by descending doc_id, nulls last, then text hash; a table of one row is its own next; an empty table gives no rows; no
column but doc_id and text is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import _BASE, _powers, blocks, documents, mix64, row_hash, side, text_or_empty, written
from tidemill.llm.ranks import ranked

SLOTS = 64
LOW_SLOTS = 16
LEVELS = 12
_EMPTY = 0xFFFF

_LOW_BIT = np.array([(x & -x).bit_length() - 1 if x else 0 for x in range(256)], np.uint8)
_DEBRUIJN = 0x03F79D71B4CB0A89
_LOW_BIT_64 = np.zeros(64, np.uint8)
for _i in range(64):
    _LOW_BIT_64[((1 << _i) * _DEBRUIJN % (1 << 64)) >> 58] = _i


def _labels(units: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6, different for neighbours of one text; ``first`` are the texts' first units."""
    if units.dtype == np.uint8:
        rounds, labels = 3, units
    else:
        differ = units[1:] ^ units[:-1]
        low = np.zeros(len(units), np.uint8)
        low[1:] = _LOW_BIT_64[((differ & (~differ + np.uint64(1))) * np.uint64(_DEBRUIJN)) >> np.uint64(58)]
        low[first] = 0
        labels = 2 * low + ((units >> low.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
        rounds = 3
    for _ in range(rounds):
        low = np.zeros(len(labels), np.uint8)
        low[1:] = _LOW_BIT[labels[1:] ^ labels[:-1]]
        low[first] = 0
        labels = 2 * low + ((labels >> low) & 1)
    return labels


def _name(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * _powers(len(units), _BASE)[: len(units)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * _powers(len(units), pow(_BASE, -1, 1 << 64))[starts])


_BYTE_NAMES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def parse(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level: names of the phrases, each text's first phrase, and where each phrase begins among the symbols.

    Every text has at least one symbol; ``first`` are the places where texts begin.
    """
    n = len(symbols)
    opens = np.zeros(n, bool)
    opens[first] = True
    new = opens.copy()
    new[1:] |= symbols[1:] != symbols[:-1]
    unit_at = np.flatnonzero(new)
    length = np.diff(np.concatenate([unit_at, [n]]))
    unit_first = np.searchsorted(unit_at, first)
    plain = symbols[unit_at]
    labels = _labels(plain, unit_first)
    begins = np.zeros(len(unit_at), bool)
    if len(unit_at) > 2:
        begins[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # A text's last unit and the unit after its first have no neighbour to be compared with.
    begins[unit_first[1:] - 1] = False
    begins[unit_first] = True
    names = _BYTE_NAMES[plain] if plain.dtype == np.uint8 else plain
    runs = length > 1
    if runs.any():
        names = names.copy()
        names[runs] = mix64(names[runs] + length[runs].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    starts = np.flatnonzero(begins)
    ends = np.concatenate([starts[1:], [len(unit_at)]])
    return _name(names, starts, ends), np.searchsorted(starts, unit_first), unit_at[starts]


def sketches(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """SLOTS 16-bit values for each text: LOW_SLOTS of the phrases of level 1, the others of higher levels."""
    n = len(offsets) - 1
    least = np.full(n * SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
    sizes = np.diff(offsets)
    owners = np.flatnonzero(sizes)
    symbols, first = body, offsets[:-1][owners]
    for level in range(1, LEVELS + 1):
        if not len(owners):
            break
        symbols, first, _ = parse(symbols, first)
        counts = np.diff(np.concatenate([first, [len(symbols)]]))
        doc = np.repeat(owners, counts)
        mixed = mix64(symbols + np.uint64(level))
        # The slots of the shortest phrases are kept apart, so that short and long texts are compared alike.
        low, span = (0, LOW_SLOTS) if level == 1 else (LOW_SLOTS, SLOTS - LOW_SLOTS)
        slot = low + ((mixed >> np.uint64(32)) % np.uint64(span)).astype(np.int64)
        np.minimum.at(least, doc * SLOTS + slot, mixed)
        more = counts > 1
        if not more.all():
            kept = np.repeat(more, counts)
            symbols, owners = symbols[kept], owners[more]
            first = np.cumsum(counts[more]) - counts[more]
    values = np.minimum((least >> np.uint64(8)) & np.uint64(0xFFFF), np.uint64(_EMPTY - 1))
    values[least == np.uint64(0xFFFFFFFFFFFFFFFF)] = _EMPTY
    return values.astype(">u2").reshape(n, SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots among those that either fingerprint of a row uses; 1 where neither uses any."""
    used = ((a != _EMPTY) | (b != _EMPTY)).sum(axis=1)
    same = ((a == b) & (a != _EMPTY)).sum(axis=1)
    return np.where(used > 0, same / np.maximum(used, 1), 1.0)


def edit(own: str, following: str) -> str:
    """The last half of a text replaced by as much of the beginning of another."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def _sketch_texts(texts: list[bytes]) -> np.ndarray:
    body = np.frombuffer(b"".join(texts), np.uint8)
    return sketches(body, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]))


def compare(rows: list[tuple], last: tuple) -> list[list]:
    """Result columns for rows (doc_id, tie, text bytes, sketch), each followed by the next one, the last by ``last``."""
    texts = [r[2].decode("utf-8", "replace") for r in [*rows, last]]
    edited = [edit(a, b).encode() for a, b in zip(texts, texts[1:])]
    own, other = np.stack([r[3] for r in [*rows, last]]), _sketch_texts(edited)
    columns = [
        [r[0] for r in rows], [r[1] for r in rows], [len(t) for t in texts[:-1]],
        [hashlib.sha256(e).hexdigest() for e in edited],
        [x.tobytes() for x in own[:-1]], [x.tobytes() for x in other],
        likeness(own[:-1], other).tolist(), likeness(own[:-1], own[1:]).tolist(),
    ]
    return columns


_RESULT = (
    "doc_id bigint, tie bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def _batch(columns: list, part: int | None, role: str) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES)]
    n = len(columns[0])
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array([part] * n, pa.int64()), pa.array([role] * n, pa.string())], names=[*_NAMES, "part", "role"]
    )


def _edge(row: tuple, part: int, role: str) -> pa.RecordBatch:
    return _batch([[row[0]], [row[1]], *[[None]] * 6], part, role)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, held = TaskContext.get().partitionId(), None
    for block in blocks(batches, limit=1 << 20):
        texts = block.column("text").cast(pa.binary()).to_pylist()
        columns = (block.column("doc_id").to_pylist(), block.column("tie").to_pylist(), texts, _sketch_texts(texts))
        rows = list(zip(*columns))
        if held is None:
            yield _edge(rows[0], part, "first")
        else:
            rows.insert(0, held)
        if len(rows) > 1:
            yield _batch(compare(rows[:-1], rows[-1]), None, "row")
        held = rows[-1]
    if held is not None:
        yield _edge(held, part, "last")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, limit=1 << 20):
        texts = block.column("text").cast(pa.binary()).to_pylist()
        others = block.column("next_text").cast(pa.binary()).to_pylist()
        keys = zip(block.column("doc_id").to_pylist(), block.column("tie").to_pylist())
        for key, text, other in zip(keys, texts, others):
            two = _sketch_texts([text, other])
            yield _batch(compare([(*key, text, two[0])], (None, None, other, two[1])), None, "row")


def _edge_pairs(edges: DataFrame) -> DataFrame:
    """(a, a_tie, b, b_tie): the last row of every partition and the first row of the next one that has any; after the last
    partition comes the first. ``edges`` has two rows per partition."""
    lasts = edges.filter("role = 'last'").select("part", F.col("doc_id").alias("a"), F.col("tie").alias("a_tie"))
    firsts = edges.filter("role = 'first'").select("part", F.col("doc_id").alias("b"), F.col("tie").alias("b_tie"))
    numbers = ranked(firsts.withColumn("every", F.lit(0)), "every", ["part"])
    numbers = written(numbers.select("part", "_rank", "_size", "b", "b_tie"), "edge-ranks")
    following = numbers.select(F.col("_rank").alias("_next"), "b", "b_tie")
    own = lasts.join(numbers.select("part", ((F.col("_rank") + 1) % F.col("_size")).alias("_next")), "part")
    return written(own.join(following, "_next").select("a", "a_tie", "b", "b_tie"), "edge-pairs")


def fingerprints(docs: DataFrame, rows_per_part: int = 10_000) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint"), row_hash().alias("tie"), text_or_empty().alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // rows_per_part))
    # The row number cuts rows that repeat an id and a text over several partitions.
    dealt = texts.withColumn("_row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(parts, *order, "_row").sortWithinPartitions(*order, "_row").drop("_row")
    found = written(dealt.mapInArrow(_stream, f"{_RESULT}, part bigint, role string"), "fingerprints")
    result = found.filter("role = 'row'").select(*_NAMES)
    pairs = _edge_pairs(found.filter("role != 'row'").select("part", "role", "doc_id", "tie"))
    keys = pairs.selectExpr("a AS id", "a_tie AS hash").union(pairs.select("b", "b_tie")).distinct()
    keys = written(keys, "edge-keys")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("hash"))
    ends = texts.join(side(keys, 24), same).dropDuplicates(["id", "hash"]).select("id", "hash", "text")
    ends = written(ends, "edge-texts")  # two texts for each partition at most
    left = ends.toDF("a_id", "a_hash", "text")
    right = ends.toDF("b_id", "b_hash", "next_text")
    joined = pairs.join(left, F.col("a").eqNullSafe(F.col("a_id")) & (F.col("a_tie") == F.col("a_hash")))
    joined = joined.join(right, F.col("b").eqNullSafe(F.col("b_id")) & (F.col("b_tie") == F.col("b_hash")))
    rest = joined.select(F.col("a").alias("doc_id"), F.col("a_tie").alias("tie"), "text", "next_text")
    result = result.unionByName(rest.mapInArrow(_ends, f"{_RESULT}, part bigint, role string").select(*_NAMES))
    codes = {c: F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")}
    return result.select(*[codes.get(c, F.col(c)) for c in _NAMES if c != "tie"])


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
