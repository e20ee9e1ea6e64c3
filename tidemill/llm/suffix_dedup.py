"""Removal of repeated passages: every byte covered by a string of ``width`` bytes that also starts elsewhere.

Dealing. A window of ``width`` bytes is represented by the least hash among its ``K``-byte strings (its anchor); equal
windows have the same anchor at the same place. Windows are told apart by whether the anchor lies in their first or second
half, so that all windows of one anchor and half share a core of more than half their length. One row per anchor and half:
hash of the core (key), hash of the bytes that its windows cover (cover), first and last start. Keys that occur once cannot
repeat. Keys with one cover that occur twice or more are repeated as a whole. Both are settled by aggregation alone, so
exact copies, however many, never meet in a task.

Search. For the keys that are left, each different cover is sent once, by key, to a task. It builds the Burrows-Wheeler
transform of a collection of covers (a few MB at a time) and derives the common prefixes of neighbouring suffixes in order
of increasing value: a breadth-first backward extension of intervals settles the entries equal to l in step l and
stops at ``width``. What is not settled then has a common prefix of ``width`` or more. A key with more covers than
``key_covers`` is not collected: its windows are hashed one by one and counted by aggregation.

Removal. The spans of a document (their number is bounded by its length) join its text again: the one shuffle of texts. The
join that cuts covers out of texts is a broadcast while the checked size of what it asks for allows.

Defined results: a null text has no bytes; matches within one document and overlapping ones count; rows that repeat are
occurrences of their own; texts shorter than ``width`` are kept whole; an empty table gives no rows; no column but doc_id
and text is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Spans, blocks, documents, fits, row_hash, side, text_bytes, text_or_empty, written

WIDTH = 400
K = 32
KEY_COVERS = 2000
COLLECTION_BYTES = 1 << 20
START_DEPTH = 8

_PLACE_BITS = np.uint64(28)
_PLACE = np.uint64((1 << 28) - 1)


def anchors(body: np.ndarray, offsets: np.ndarray, width: int = WIDTH, k: int = K) -> dict[str, np.ndarray]:
    """One entry per anchor and half: doc, key, cover, first and last start (places in the document)."""
    reach = width - k + 1
    half = (reach - 1) // 2 + 1
    sizes = np.diff(offsets)
    n = len(body)
    empty = {name: np.zeros(0, np.int64) for name in ("doc", "key", "cover", "first", "last")}
    if n < width or not (sizes >= width).any():
        return empty
    spans = Spans(body)
    ranked = (spans.sums[k:] - spans.sums[:-k]) * spans.inverse[: n - k + 1]
    ranked *= np.uint64(0xD6E8FEB86659FD93)
    ranked &= ~_PLACE
    ranked |= np.arange(len(ranked), dtype=np.uint64)
    least, covered = ranked, 1
    while covered * 2 <= reach:
        least = np.minimum(least[: len(least) - covered], least[covered:])
        covered *= 2
    if covered < reach:
        least = np.minimum(least[: len(least) - (reach - covered)], least[reach - covered :])
    docs = np.flatnonzero(sizes >= width)
    counts = sizes[docs] - width + 1
    ends = np.cumsum(counts)
    starts = np.repeat(offsets[:-1][docs] - (ends - counts), counts) + np.arange(ends[-1])
    anchor = (least[starts] & _PLACE).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    new[(ends - counts)] = True
    begin = np.flatnonzero(new)
    stop = np.concatenate([begin[1:], [len(starts)]]) - 1
    first, last, at = starts[begin], starts[stop], anchor[begin]
    doc = np.repeat(docs, counts)[begin]
    parts = []
    # The anchor lies at least ``half`` into the window: the core reaches from there to the window that starts earliest.
    far = first <= at - half
    parts.append((doc[far], first[far], np.minimum(last, at - half)[far], at[far] - half, at[far] - (reach - 1) + width, 1))
    near = last > at - half
    parts.append((doc[near], np.maximum(first, at - half + 1)[near], last[near], at[near], at[near] - half + 1 + width, 2))
    out: dict[str, list] = {name: [] for name in empty}
    for own, a, b, core, core_end, kind in parts:
        out["doc"].append(own)
        out["key"].append((spans.hash(core, core_end) ^ np.uint64(kind)).view(np.int64))
        out["cover"].append(spans.hash(a, b + width).view(np.int64))
        out["first"].append(a - offsets[own])
        out["last"].append(b - offsets[own])
    return {name: np.concatenate(v) for name, v in out.items()}


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` symbols at least, by prefix doubling; the last symbol is unique."""
    n = len(text)
    rank = np.zeros(n, np.int64)
    order = np.argsort(text, kind="stable")
    rank[order] = np.cumsum(np.concatenate([[0], text[order][1:] != text[order][:-1]]))
    covered = 1
    while covered < depth and rank[order[-1]] < n - 1:
        follow = np.zeros(n, np.int64)
        follow[: n - covered] = rank[covered:] + 1
        both = rank * (n + 1) + follow
        order = np.argsort(both)
        ordered = both[order]
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        covered *= 2
    return order


def long_prefixes(text: np.ndarray, width: int, depth: int = START_DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and for each place in it whether the suffix shares ``width`` symbols or more with the one before.

    Entries below ``depth`` are read off the first symbols; from there on intervals are extended backwards, level by level.
    """
    n = len(text)
    order = suffix_order(text, width)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)
    step[by_symbol] = np.arange(n)
    common = np.full(n + 1, -1, np.int32)
    common[0] = common[n] = 0
    same = np.ones(n - 1, bool)
    for i in range(min(depth, width)):
        a, b = order[:-1] + i, order[1:] + i
        now = same & (a < n) & (b < n)
        now[now] = text[a[now]] == text[b[now]]
        common[1:n][same & ~now] = i
        same = now
    level = min(depth, width)
    # Intervals of strings of ``level`` symbols whose right neighbour was settled in the step before.
    edges = np.flatnonzero((common[: n + 1] >= 0))
    left, right = edges[:-1], edges[1:] - 1
    settled = (common[right + 1] == level - 1) & (right + 1 < n)
    left, right = left[settled], right[settled]
    while level < width and len(left):
        sizes = right - left + 1
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(left)), sizes)
        places = np.repeat(left - (ends - sizes), sizes) + np.arange(ends[-1])
        symbol, target = bwt[places], step[places]
        if (sizes > 1).any():
            key = owner * (int(text.max()) + 1) + symbol
            by_key = np.argsort(key, kind="stable")
            key, target = key[by_key], target[by_key]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            begin = np.flatnonzero(new)
            left, right = target[begin], target[np.concatenate([begin[1:], [len(key)]]) - 1]
        else:
            left = right = target
        fresh = common[right + 1] < 0
        left, right = left[fresh], right[fresh]
        common[right + 1] = level
        level += 1
    return order, common[:n] < 0


def repeated_starts(covers: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """For each cover, which of its windows (by start) also occurs at another start of the collection."""
    lengths = np.array([len(c) for c in covers])
    n = int(lengths.sum()) + len(covers)
    text = np.empty(n, np.int64)
    ends = np.cumsum(lengths + 1) - 1
    inside = np.ones(n, bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(covers), np.uint8).astype(np.int64) + len(covers)
    text[ends] = np.arange(len(covers))[::-1]
    order, shares = long_prefixes(text, width)
    found = np.zeros(n, bool)
    found[order] = shares | np.concatenate([shares[1:], [False]])
    return [found[e - size : e - width + 1] for e, size in zip(ends.tolist(), lengths.tolist())]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _anchor_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=1 << 20):
            found = anchors(*text_bytes(block.column("text")), width)
            own = found.pop("doc")
            ids = [block.column(c).to_numpy(zero_copy_only=False)[own] for c in ("id0", "tie")]
            arrays = [pa.array(x, pa.int64()) for x in (*ids, found["key"], found["cover"])]
            arrays += [pa.array(found[c], pa.int32()) for c in ("first", "last")]
            yield pa.RecordBatch.from_arrays(arrays, names=["id0", "tie", "key", "cover", "first", "last"])

    return run


_ROWS = "id0 bigint, tie bigint, key bigint, cover bigint, first int, last int"
_COVERS = "key bigint, cover bigint, twice boolean, body binary"


def _cut_covers(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            out = []
            texts = block.column("text").cast(pa.binary()).to_pylist()
            for text, asked in zip(texts, block.column("asked").to_pylist()):
                out += [(a["key"], a["cover"], a["twice"], text[a["first"] : a["last"] + width]) for a in asked]
            columns = list(zip(*out)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["key", "cover", "twice", "body"]
            )

    return run


def _search(width: int, collection_bytes: int):
    """Repeated runs of starts (key, cover, a, b), in each collection of whole keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def finish() -> pa.RecordBatch:
            keys, covers, a, b = [], [], [], []
            for row, flags in zip(rows, repeated_starts([r[3] for r in rows], width)):
                first, last = _runs(np.ones(len(flags), bool) if row[2] else flags)
                keys += [row[0]] * len(first)
                covers += [row[1]] * len(first)
                a += first.tolist()
                b += last.tolist()
            arrays = [pa.array(x, pa.int64()) for x in (keys, covers, a, b)]
            return pa.RecordBatch.from_arrays(arrays, names=["key", "cover", "a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "cover", "twice", "body"))):
                if rows and row[0] != rows[-1][0] and size >= collection_bytes:
                    yield finish()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield finish()

    return run


def _windows(width: int):
    """Hash of every window of a cover, for keys with too many covers to collect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for key, cover, twice, body in zip(*(batch.column(c).to_pylist() for c in ("key", "cover", "twice", "body"))):
                starts = np.arange(len(body) - width + 1)
                hashes = Spans(np.frombuffer(body, np.uint8)).hash(starts, starts + width).view(np.int64)
                for column, values in zip(columns, (key, cover, starts, hashes, 2 if twice else 1)):
                    column.append(np.broadcast_to(values, len(starts)))
            arrays = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "cover", "a", "hash", "times"])

    return run


def repeated_spans(
    texts: DataFrame, width: int = WIDTH, key_covers: int = KEY_COVERS, collection_bytes: int = COLLECTION_BYTES
) -> DataFrame:
    """(id0, tie, first, last): runs of starts of repeated windows; ``texts`` has id0, tie and text."""
    rows = written(texts.mapInArrow(_anchor_rows(width), _ROWS), "passages-anchors")
    keys = rows.groupBy("key").agg(F.count("*").alias("_n"), F.min("cover").alias("_a"), F.max("cover").alias("_b"))
    keys = keys.filter("_n > 1").select("key", (F.col("_a") == F.col("_b")).alias("whole"))
    keys = written(keys, "passages-keys")
    shared = written(rows.join(side(keys, 24), "key"), "passages-shared")
    spans = shared.filter("whole").select("id0", "tie", "first", "last")
    mixed = shared.filter("NOT whole").drop("whole")
    if not mixed.limit(1).count():
        return spans
    covers = mixed.groupBy("key", "cover").agg(
        (F.count("*") > 1).alias("twice"), F.min(F.struct("id0", "tie", "first", "last")).alias("at")
    )
    covers = written(covers, "passages-covers")
    crowded = covers.groupBy("key").agg(F.count("*").alias("_n")).filter(F.col("_n") > key_covers).select("key")
    crowded = written(crowded, "passages-crowded")

    def bodies(some: DataFrame) -> DataFrame:
        asked = some.groupBy("at.id0", "at.tie").agg(
            F.collect_list(F.struct("key", "cover", "twice", "at.first", "at.last")).alias("asked")
        )
        asked = written(asked, "passages-asked")
        per_doc = 24 + 40 * (some.count() // max(1, asked.count()) + 1)
        joined = texts.join(F.broadcast(asked) if fits(asked, per_doc) else asked, ["id0", "tie"])
        # Rows that repeat a doc_id and a text bring the same cover more than once.
        return joined.select("text", "asked").mapInArrow(_cut_covers(width), _COVERS)

    few = covers.join(side(crowded, 16), "key", "left_anti")
    dealt = bodies(few).dropDuplicates(["key", "cover"]) if _repeats(texts) else bodies(few)
    dealt = dealt.repartition("key").sortWithinPartitions("key", "cover")
    found = written(
        dealt.mapInArrow(_search(width, collection_bytes), "key bigint, cover bigint, a bigint, b bigint"), "passages-found"
    )
    if crowded.limit(1).count():
        many = bodies(covers.join(side(crowded, 16), "key", "left_semi"))
        many = many.dropDuplicates(["key", "cover"]) if _repeats(texts) else many
        each = many.mapInArrow(_windows(width), "key bigint, cover bigint, a bigint, hash bigint, times bigint")
        each = written(each, "passages-windows")
        twice = each.groupBy("key", "hash").agg(F.sum("times").alias("_n")).filter("_n > 1").select("key", "hash")
        again = each.join(written(twice, "passages-twice"), ["key", "hash"])
        found = found.unionByName(again.select("key", "cover", "a", F.col("a").alias("b")))
    place = mixed.join(found, ["key", "cover"])
    moved = place.select("id0", "tie", (F.col("first") + F.col("a")).alias("first"), (F.col("first") + F.col("b")).alias("last"))
    return spans.unionByName(moved.select("id0", "tie", F.col("first").cast("int"), F.col("last").cast("int")))


def _repeats(texts: DataFrame) -> bool:
    """Whether a doc_id and text occur in more than one row."""
    return texts.groupBy("id0", "tie").agg(F.count("*").alias("_n")).filter("_n > 1").limit(1).count() > 0


def _removal(width: int, keep_text: bool):
    names = ["doc_id", "row_hash", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * keep_text
    types = [pa.int64()] * 5 + [pa.string()] + [pa.binary()] * keep_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            out = []
            columns = [block.column("doc_id").to_pylist(), block.column("tie").to_pylist()]
            columns += [block.column("text").cast(pa.binary()).to_pylist(), block.column("spans").to_pylist()]
            for doc_id, tie, text, spans in zip(*columns):
                removed = n_spans = at = 0
                kept = []
                for a, b in sorted((s["first"], s["last"] + width) for s in spans or ()):
                    if b <= at:
                        continue
                    if a > at or not n_spans:
                        kept.append(text[at:a])
                        n_spans += 1
                    removed += b - max(a, at)
                    at = b
                kept.append(text[at:])
                rest = b"".join(kept)
                row = (doc_id, tie, len(text), removed, n_spans, hashlib.sha256(rest).hexdigest())
                out.append(row + (rest,) * keep_text)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def remove_repeats(
    docs: DataFrame,
    width: int = WIDTH,
    keep_text: bool = False,
    key_covers: int = KEY_COVERS,
    collection_bytes: int = COLLECTION_BYTES,
) -> DataFrame:
    """One row per document: doc_id, row_hash, n_bytes, n_removed, n_spans, kept_sha256, with ``keep_text`` kept_text."""
    texts = docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id0"),
        row_hash().alias("tie"),
        text_or_empty().alias("text"),
    )
    spans = repeated_spans(texts.drop("doc_id"), width, key_covers, collection_bytes)
    spans = spans.distinct().groupBy("id0", "tie").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    # Spans grow with the texts: this join moves the texts at every size.
    joined = texts.join(written(spans, "passages-spans"), ["id0", "tie"], "left")
    schema = "doc_id bigint, row_hash bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema += ", kept_text binary" if keep_text else ""
    return joined.select("doc_id", "tie", "text", "spans").mapInArrow(_removal(width, keep_text), schema)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("row_hash")
