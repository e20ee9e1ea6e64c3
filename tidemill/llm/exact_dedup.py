"""Exact duplicates by progressive refinement: length, then hash of the first characters, then hash of the whole.

Two texts are equal when they are identical after every blank (space, tab, line feed, vertical tab, form feed,
carriage return) is deleted. Each level keeps only the keys that two rows share, so the whole-text hash is needed
for survivors alone. Rows travel as ids and numbers; the text never enters a shuffle. A group that holds a third of
all rows is one row per map task in every aggregation, and on the row side of a plain join whose partitions Spark
may split.

Defined results: a null text counts as empty, so all null, empty and blank texts are one group; of equal texts the
one with the most characters stays, then the smallest doc_id, then (rows that repeat a doc_id and a text) one of
them; a null doc_id comes after every other; an empty table gives no rows; columns other than doc_id and text are
not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import blank_free, documents, fits, row_hash, side, text_or_empty, written

HEAD = 64


def exact_dedup(docs: DataFrame, head: int = HEAD, digests: bool = False) -> DataFrame:
    """One row per document: doc_id, row_hash, keep_id, group_size, kept and text_sha256.

    ``text_sha256`` is filled for the rows that reached the last level, with ``digests`` for every row.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    scan = texts.withColumn("norm", blank_free(F.col("text"))).select(
        "doc_id",
        row_hash().alias("row_hash"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.length("norm").cast("bigint").alias("n_norm"),
        F.xxhash64(F.substring("norm", 1, head)).alias("head"),
        "norm",
    )
    sized = written(scan.select("n_norm", "head"), "exact-sizes")
    lengths = written(_shared(sized, ["n_norm"]), "exact-lengths")
    survivors = sized.join(side(lengths, 16), "n_norm", "left_semi")
    heads = written(_shared(survivors, ["n_norm", "head"]).withColumn("_deep", F.lit(True)), "exact-heads")
    digest = F.sha2(F.col("norm").cast("binary"), 256)
    narrow = ["doc_id", "row_hash", "n_chars", "n_norm", "head"]
    if fits(heads, 32):
        flagged = scan.join(F.broadcast(heads), ["n_norm", "head"], "left")
        chosen = digest if digests else F.when(F.col("_deep"), digest)
        deep = flagged.select(*narrow, "_deep", chosen.alias("text_sha256"))
    else:
        # Too many keys to hold: hashing a text where it is read costs less than moving it to its key.
        deep = scan.select(*narrow, digest.alias("text_sha256")).join(heads, ["n_norm", "head"], "left")
    deep = written(deep.withColumn("_row", F.monotonically_increasing_id()), "exact-hashes")
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "_row")
    groups = (
        deep.filter("_deep")
        .groupBy("n_norm", "text_sha256")
        .agg(F.count("*").alias("group_size"), F.min(order).alias("first"))
        .filter("group_size > 1")
        .select("n_norm", "text_sha256", "group_size", "first.doc_id", "first._row")
        .toDF("n_norm", "text_sha256", "group_size", "keep_id", "_keep_row")
    )
    groups = written(groups, "exact-groups")
    single = F.col("group_size").isNull()
    return deep.join(groups, ["n_norm", "text_sha256"], "left").select(
        "doc_id",
        "row_hash",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (single | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        "text_sha256",
    )


def _shared(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), digests=True).drop("row_hash")


ORACLE_SQL = """
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS size,
        regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
    row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body ORDER BY size DESC, doc_id)
"""
