"""Corpus pipeline: language filter, exact and near duplicates, source mix, packed sequences.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes each stage's result as Parquet and reads it back for the next one.

1. language: rows whose language cannot be told (no letter, null, or a best posterior below 0.5) go.
2. exact: of equal texts the one with the most characters stays.
3. near: of documents linked by word shingles the one with the smallest id stays.
4. mix: documents are repeated or left out so that sources reach their targets.
5. pack: one row per piece of a packed sequence.

Rows that repeat a doc_id and a text leave stage 2 once. A null doc_id is kept through all stages like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents, importable, repeat_rows, row_hash, written
from tidemill.llm.exact_dedup import exact_dedup
from tidemill.llm.langid import UNDETERMINED, identify
from tidemill.llm.mixing import mix
from tidemill.llm.ngram_join import ngram_components
from tidemill.llm.packing import pack

MIN_LANGUAGE_SCORE = 0.5
# Executors come to the last stage with what the stages before left in them, so its workers keep a smaller table of words.
PACK_WORDS = 400_000
PACK_BYTES = 2 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    known = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    rows = docs.select("doc_id", "text", "lang", row_hash().alias("row_hash"))
    found = identify(rows, carry=("doc_id", "row_hash"))
    return repeat_rows(docs, found.select("doc_id", "row_hash", known.cast("int").alias("copies")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = exact_dedup(docs)
    return repeat_rows(docs, found.select("doc_id", "row_hash", F.col("kept").cast("int").alias("copies")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_components(docs)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")).cast("int")
    return repeat_rows(docs, found.select("doc_id", "row_hash", stays.alias("copies")))


def balance(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeat_rows(docs, mix(docs).select("doc_id", "row_hash", "copies"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, known_words=PACK_WORDS, text_bytes=PACK_BYTES)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", balance), ("pack", packed)]

# Which documents the mix takes and where sequences are cut cannot be said in SQL; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
