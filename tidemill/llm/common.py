"""Helpers shared by the training-data operators: row keys, written tables, checked broadcasts, vector text work."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.keyed import top_per_key
from tidemill.session import shared_folder

# The six characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
# A side may be broadcast only when its rows, with what a hash table takes for each, stay below this in memory.
BROADCAST_BYTES = 64 << 20
HASH_ROW_BYTES = 80
# Bytes of text handled at once inside a task, and in one Arrow batch on its way there.
BLOCK_BYTES = 1 << 20


def importable(spark: SparkSession) -> None:
    """Lets Python workers that start on this machine import the package (a cluster ships it to its executors), and bounds
    Arrow batches by bytes, so that long texts do not meet by the thousand in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * BLOCK_BYTES))
    known = spark.sparkContext.environment
    here = str(Path(__file__).resolve().parents[2])
    if here not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [here, known.get("PYTHONPATH", "")]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Store ``df`` in the shared folder and read it back: lineage ends here and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark, purpose)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is small enough to be broadcast; counts rows from the file footers."""
    return df.count() * (row_bytes + HASH_ROW_BYTES) <= limit


def side(df: DataFrame, row_bytes: int) -> DataFrame:
    """The smaller side of a join: broadcast if its checked size allows, else left to a shuffle join."""
    return F.broadcast(df) if fits(df, row_bytes) else df


def repeat_rows(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Every row of ``docs`` as often as ``copies`` (doc_id, row_hash, copies) says; the columns stay as they are.

    Rows that share doc_id and text have one decision together: the sum of theirs.
    """
    keys = ["doc_id", "row_hash"]
    decided = copies.groupBy(*keys).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    decided = written(decided.toDF("_id", "_hash", "_copies", "_rows"), "decisions")
    repeated = decided.filter("_rows > 1").limit(1).count()
    wanted = side(decided.filter("_copies > 0"), 40)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (row_hash() == F.col("_hash"))
    kept = docs.join(wanted, same)
    if repeated:
        turn = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash"))
        kept = kept.withColumn("_turn", turn).filter("_turn = 1")
    every = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")
    if decided.filter("_copies > 1").limit(1).count():
        kept = kept.select(*docs.columns, every)
    return kept.select(*docs.columns)


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def row_hash() -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(text_or_empty())


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of all ids that no label is learned from; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def bounded_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows of each class in ``key``: those with the smallest hash of doc_id (column ``_order``).

    A first cut by hash leaves about 2 n rows of a class, from its counted size, so that what meets in one task for the
    exact cut does not grow with the table. Classes are few: their counts are collected.
    """
    counts = {r[0]: r[1] for r in df.groupBy(key).agg(F.count("*")).collect()}
    hashed = df.withColumn("_order", F.xxhash64("doc_id"))
    large = {value: count for value, count in counts.items() if count > 4 * n and value is not None}
    if large:
        span = 1 << 40
        pairs = [F.lit(x) for value, count in large.items() for x in (value, span * 2 * n // count)]
        cut = F.coalesce(F.element_at(F.create_map(*pairs), F.col(key)), F.lit(span))
        hashed = hashed.filter(F.pmod(F.xxhash64("_order"), F.lit(span)) < cut)
    return top_per_key(hashed, [key], [F.col("_order"), F.col("doc_id")], n).filter(F.col(key).isNotNull())


def blank_free(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text that is not null."""
    inner = F.btrim(text, F.lit("".join(BLANKS)))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, r"[ \t\n\x0B\f\r]+")))


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a block holds about ``limit`` bytes of text (one text at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) // limit) if len(sizes) else sizes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
    give_back()


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: Python workers live on, and what one stage freed would
    stay theirs beside the JVM's share of the executor."""
    for base in [b for b, powers in _POWERS.items() if len(powers) > 2 * BLOCK_BYTES]:
        del _POWERS[base]
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one UTF-8 byte array, and the n + 1 offsets; a null text has no bytes."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def arrow(df: DataFrame) -> pa.Schema:
    """Arrow form of a Spark schema, for tasks that build their own record batches."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the finaliser of a public 64-bit mixing function)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; the longest asked for so far is kept."""
    if base not in _POWERS or len(_POWERS[base]) <= n:
        out = np.full(n + 1, np.uint64(base))
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][: n + 1]


class Spans:
    """Hashes of arbitrary ranges of one byte (or symbol) array in constant time each.

    Polynomial prefix sums modulo 2**64 over randomised symbols; a range's sum is divided by the power of its start, so
    equal contents have equal hashes wherever they stand, in any block. The result is mixed over all bits.
    """

    def __init__(self, symbols: np.ndarray, base: int = _BASE):
        n = len(symbols)
        self.inverse = _powers(n, pow(base, -1, 1 << 64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODES[symbols] * _powers(n, base)[:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix64(raw + mix64((end - start).astype(np.uint64)))


BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
