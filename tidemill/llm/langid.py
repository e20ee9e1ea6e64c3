"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning: the labelled rows are a bounded sample, the ``rows_per_lang`` rows of each language with the smallest id
hash, read whole. Counts per language and bucket are summed in tasks and give one log-probability matrix, which is
broadcast (buckets x languages; ``MAX_LANGS`` bounds it, more languages are an error, never a cut). Scoring: a map
over the scan without any shuffle; the n-grams of a block of documents are hashed as one array, their matrix rows
are gathered and summed per document. Whole texts are read.

Defined results: null, empty and letterless texts get ``und`` with score 0, as does every text if there is nothing
to learn from; equal posteriors take the first language by code point; rows that repeat are scored alike; no column
but doc_id, text and lang is read, and lang only for learning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import blocks, bounded_sample, documents, held_out

BITS = 16
GRAMS = (1, 2, 3)
ROWS_PER_LANG = 1000
MAX_LANGS = 400
COUNT_TASKS = 8
UNDETERMINED = "und"

_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)
_LETTER = regex.compile(r"\p{L}")
_PAD = 1 << BITS
_FOUND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def _classes() -> np.ndarray:
    """Symbol of each code point below 65536: letters stand for themselves, everything else is one gap symbol."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint32)


def gram_buckets(texts: list[str | None], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every text and the first position of each text in that list.

    Each text is followed by a terminator; grams that would reach over it get the bucket ``_PAD``.
    """
    joined = "".join((t or "").replace("\0", " ").lower() + "\0" for t in texts)
    symbols = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(symbols == 0)
    symbols = np.where(symbols < (1 << 16), classes[np.minimum(symbols, 0xFFFF)], symbols).astype(np.uint32)
    symbols[ends] = 0
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    parts = np.full((len(symbols), len(GRAMS)), _PAD, np.uint32)
    mixed = np.full(len(symbols), 0x1234567, np.uint32)
    broken = symbols == 0
    for i, n in enumerate(range(1, max(GRAMS) + 1)):
        shift = n - 1
        following = np.zeros_like(symbols)
        following[: len(symbols) - shift] = symbols[shift:]
        mixed = (mixed ^ following) * np.uint32(_FACTORS[i])
        mixed ^= mixed >> np.uint32(15)
        broken = broken | (following == 0)
        if n in GRAMS:
            bucket = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)
            parts[:, GRAMS.index(n)] = np.where(broken, _PAD, bucket)
    return parts.reshape(-1), starts * len(GRAMS)


def fit_counts(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> dict[str, np.ndarray]:
    """Gram counts per language over the bounded sample of rows that may be learned from."""
    labelled = docs.filter(F.col("lang").isNotNull() & ~held_out())
    chosen = bounded_sample(labelled.select("doc_id", "lang"), "lang", rows_per_lang).select("lang", "_order").distinct()
    sample = (
        labelled.withColumn("_order", F.xxhash64("doc_id"))
        .join(F.broadcast(chosen), ["lang", "_order"], "left_semi")  # rows_per_lang rows of each language at most
        .select("lang", "text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, totals = _classes(), {}
        for block in blocks(batches):
            langs, texts = block.column("lang").to_pylist(), block.column("text").to_pylist()
            for lang in sorted(set(langs)):
                grams, _ = gram_buckets([t for t, own in zip(texts, langs) if own == lang], classes)
                found = np.bincount(grams, minlength=_PAD + 1)[:_PAD]
                totals[lang] = totals.get(lang, 0) + found
        for lang, total in totals.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "counts": [total.astype("<u4").tobytes()]})

    # The sample is bounded; dealt to few tasks, it gives few count vectors. The scan below keeps its own tasks.
    partial = sample.repartition(COUNT_TASKS).mapInArrow(count, "lang string, counts binary").collect()
    sums: dict[str, np.ndarray] = {}
    for row in partial:
        sums[row.lang] = sums.get(row.lang, 0) + np.frombuffer(row.counts, "<u4").astype(np.int64)
    if len(sums) > MAX_LANGS:
        raise ValueError(f"{len(sums)} languages; the matrix is made for at most {MAX_LANGS}")
    return sums


def log_matrix(counts: dict[str, np.ndarray], smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log-probabilities; the last column stands for padding and weighs nothing."""
    langs = sorted(counts)
    matrix = np.zeros((len(langs), _PAD + 1), np.float32)
    for i, lang in enumerate(langs):
        smooth = counts[lang] + smoothing
        matrix[i, :_PAD] = np.log(smooth / smooth.sum())
    return langs, matrix


def score_texts(texts: list[str | None], langs: list[str], matrix: np.ndarray, classes) -> tuple[list[str], np.ndarray]:
    if not texts:
        return [], np.zeros(0)
    known = np.array([bool(t) and _LETTER.search(t) is not None for t in texts])
    if not langs:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    grams, starts = gram_buckets(texts, classes)
    logs = np.stack([np.add.reduceat(row[grams], starts, dtype=np.float64) for row in matrix])
    best = logs.argmax(axis=0)
    posterior = 1.0 / np.exp(logs - logs.max(axis=0)).sum(axis=0)
    names = [langs[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
    return names, np.where(known, posterior, 0.0)


def identify(
    docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), labelled: DataFrame | None = None, rows_per_lang: int = ROWS_PER_LANG
) -> DataFrame:
    """The ``carry`` columns of every row with lang_pred and score; learns from ``labelled`` (default: ``docs``)."""
    spark = docs.sparkSession
    learn = docs if labelled is None else labelled
    model = spark.sparkContext.broadcast(log_matrix(fit_counts(learn, rows_per_lang)))
    rows = docs.select(*carry, F.col("text").alias("_text"))
    out = T.StructType([*docs.select(*carry).schema.fields, *_FOUND.fields])
    names = out.names

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix = model.value
        classes = _classes()
        for block in blocks(batches, "_text"):
            found, scores = score_texts(block.column("_text").to_pylist(), langs, matrix, classes)
            arrays = [*block.columns[:-1], pa.array(found, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(predict, out)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(documents(spark, sf_dir))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
