"""Quality scores by votes of the nearest labelled documents in a latent-semantic space.

Terms of a text are hashed: its words (lower-cased in A-Z), its shapes (sequences of one to four character classes, where a run
of letters, digits or blanks is one symbol and every other sign stands for itself), words and lines that repeat what stood just
before. A text is a vector of log counts, weighted by how rare a term is among all documents; words and shapes have length one
each before they are put side by side. The labelled sample's matrix gives the latent space: its leading right singular
vectors, found by subspace iteration in one task. Labelled documents are kept as unit vectors in that space and broadcast:
``rows_per_class`` rows of two classes times ``DIM`` numbers, whatever the corpus.

Scoring is a map over the scan: the block's documents are projected, one matrix product gives the exact cosines with every
labelled vector, and the labels of the ``NEIGHBOURS`` nearest ones (all that tie with the last of them too) are averaged, weighted by
the cosine to the power ``SHARPNESS`` and by how often their class stands among all labels compared with the sample.

Document frequencies cover every text. The sample is bounded: per class the ``rows_per_class`` rows with the smallest id hash,
read whole, outside the held-out fifth.

Texts of more than ``_PIECE`` characters are read in pieces, whole.

Defined results: null, empty and blank texts, and any whose terms the latent space does not know, get the share of label 1;
several labels of a document count as 1 if one is, and of rows that repeat a labelled id the
first text is learned; null labels are ignored; with labels of one class only the score is 1 or 0
for all, with none 0; rows that repeat score alike; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import Spans, blocks, bounded_sample, documents, held_out, text_bytes

WORD_BITS = 12
SHAPE_BITS = 12
SHAPES = (1, 2, 3, 4)
DIM = 64
NEIGHBOURS = 15
SHARPNESS = 8
ROWS_PER_CLASS = 1000
ROUNDS = 4

WORDS, TERMS = 1 << WORD_BITS, (1 << WORD_BITS) + (1 << SHAPE_BITS)
_SAME_WORD, _SAME_LINE = 0, 1  # buckets of repeats; words take the others
_BLOCK = 1 << 17
_DOCS = 128
_PIECE = 1 << 18

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _classes() -> np.ndarray:
    """Shape symbol of each code point below 65536: 1 capital, 2 other letter, 3 digit, 4 blank, 5 line end, 6 other sign
    beyond ASCII; signs of ASCII stand for themselves."""
    out = np.full(1 << 16, 6, np.uint8)
    for c in range(1 << 16):
        s = chr(c)
        if s.isalpha():
            out[c] = 1 if s.isupper() else 2
        elif s.isdigit():
            out[c] = 3
        elif s in "\n\r":
            out[c] = 5
        elif s.isspace():
            out[c] = 4
        elif c < 128:
            out[c] = max(c, 7)
    return out


CLASSES = _classes()


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of ``inside`` bytes; a run ends with its text."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _word_terms(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Text number times WORDS plus bucket, of every word and repeat."""
    low, found = _LOWER[body], []
    spans = Spans(low)
    for inside, bucket in ((~_BLANK[body], _SAME_WORD), ((body != 10) & (body != 13), _SAME_LINE)):
        starts, ends, text = _runs(inside, offsets)
        hashes = spans.hash(starts, ends)
        again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])) + 1
        found.append(text[again] * WORDS + bucket)
        if bucket == _SAME_WORD:
            found.append(text * WORDS + 2 + (hashes % np.uint64(WORDS - 2)).astype(np.int64))
    return np.concatenate(found)


def _shape_terms(texts: list[str]) -> np.ndarray:
    """Text number times buckets plus bucket, of every sequence of shape symbols."""
    joined = "".join(t.replace("\0", " ") + "\0" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = np.where(points < (1 << 16), CLASSES[np.minimum(points, 0xFFFF)], 2).astype(np.uint32)
    symbols[points == 0] = 0
    kept = np.ones(len(symbols), bool)
    kept[1:] = (symbols[1:] != symbols[:-1]) | (symbols[1:] == 0) | (symbols[1:] > 5)
    symbols = symbols[kept]
    text = np.cumsum(symbols == 0) - (symbols == 0)
    found, mixed, broken = [], np.full(len(symbols), 0x51ED27, np.uint32), symbols == 0
    for n in range(max(SHAPES)):
        following = np.zeros_like(symbols)
        following[: max(len(symbols) - n, 0)] = symbols[n:]
        mixed = (mixed ^ following) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        broken = broken | (following == 0)
        if n + 1 in SHAPES:
            bucket = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - SHAPE_BITS)
            found.append(((text << SHAPE_BITS) + bucket)[~broken])
    return np.concatenate(found)


def _counts(texts: list[str]) -> np.ndarray:
    n = len(texts)
    words = np.bincount(_word_terms(*text_bytes(pa.array(texts, pa.large_string()))), minlength=n * WORDS)
    shapes = np.bincount(_shape_terms(texts), minlength=n << SHAPE_BITS)
    return np.concatenate([words.reshape(n, WORDS), shapes.reshape(n, 1 << SHAPE_BITS)], axis=1)


def term_counts(texts: list[str | None]) -> np.ndarray:
    """How often each text has each term: words and repeats first, then shapes. Long texts are read in pieces of ``_PIECE``
    characters; a term does not cross the end of a piece."""
    total, owners, pieces, size = np.zeros((len(texts), TERMS), np.float32), [], [], 0

    def add() -> None:
        own, first = np.unique(owners, return_index=True)
        total[own] += np.add.reduceat(_counts(pieces), first) if len(own) < len(owners) else _counts(pieces)

    for i, text in enumerate(texts):
        text = text or ""
        for a in range(0, len(text), _PIECE):
            owners.append(i)
            pieces.append(text[a : a + _PIECE])
            size += len(pieces[-1])
            if size >= _PIECE:
                add()
                owners, pieces, size = [], [], 0
    if pieces:
        add()
    return total


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    out = np.zeros_like(counts)
    some = counts > 0
    out[some] = np.log1p(counts[some])
    out *= rarity
    for part in (out[:, :WORDS], out[:, WORDS:]):
        part /= np.maximum(np.sqrt((part * part).sum(axis=1, keepdims=True)), 1e-12)
    return out


def rarity_of(frequencies: np.ndarray, total: int) -> np.ndarray:
    return np.log((1 + total) / (1 + frequencies)).astype(np.float32)


def leading_space(matrix: np.ndarray, dim: int = DIM, seed: int = 11) -> np.ndarray:
    """Orthonormal columns that span the leading right singular vectors, by subspace iteration."""
    dim = min(dim, *matrix.shape)
    base = np.random.default_rng(seed).normal(size=(matrix.shape[1], min(dim + 16, matrix.shape[1]))).astype(np.float32)
    for _ in range(ROUNDS):
        base, _ = np.linalg.qr(matrix.T @ (matrix @ base))
    _, _, turn = np.linalg.svd(matrix @ base, full_matrices=False)
    return (base @ turn[:dim].T).astype(np.float32)


@dataclass
class Model:
    rarity: np.ndarray
    space: np.ndarray  # TERMS x DIM
    points: np.ndarray  # labelled rows x DIM, unit length
    labels: np.ndarray
    weights: np.ndarray  # what a labelled row's vote counts
    share: float  # of label 1; the score of all where only one class is known

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.points):
            return np.full(len(counts), self.share)
        found = _unit(weighted(counts, self.rarity) @ self.space)
        near = found @ self.points.T
        k = min(NEIGHBOURS, near.shape[1])
        least = np.partition(near, near.shape[1] - k, axis=1)[:, -k][:, None] - 1e-6
        votes = np.where(near >= least, np.maximum(near, 0), 0).astype(np.float64) ** SHARPNESS * self.weights
        total = votes.sum(axis=1)
        return np.clip(np.where(total > 0, votes @ self.labels / np.maximum(total, 1e-300), self.share), 0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


def _constant(share: float) -> Model:
    return Model(np.zeros(0), np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0), share)


def learn_model(rarity: np.ndarray, counts: np.ndarray, labels: np.ndarray, share: float) -> Model:
    """``share`` of label 1 among all labels; the sample's classes are weighted back to it."""
    matrix = weighted(counts, rarity)
    space = leading_space(matrix)
    own = labels.mean()
    weights = np.where(labels == 1, share / own, (1 - share) / (1 - own))
    return Model(rarity, space, _unit(matrix @ space), labels.astype(np.float64), weights, share)


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Blocks of bounded bytes and rows."""
    for block in blocks(batches, column, _BLOCK):
        for a in range(0, block.num_rows, _DOCS):
            yield block.slice(a, _DOCS)


def term_rarity(docs: DataFrame) -> np.ndarray:
    """Rarity of every term among all texts. A task sends one row per term that it has seen, however much it reads."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(TERMS + 1, np.int64)
        for part in _parts(batches, "text"):
            seen[:TERMS] += (term_counts(part.column("text").to_pylist()) > 0).sum(axis=0)
            seen[TERMS] += part.num_rows
        terms = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"term": pa.array(terms.astype(np.int32)), "n": pa.array(seen[terms])})

    found = np.zeros(TERMS + 1, np.int64)
    rows = docs.select("text").mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    for row in rows.collect():  # TERMS + 1 rows at most
        found[row.term] = row.n
    return rarity_of(found[:TERMS], int(found[TERMS]))


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    marks = marks.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    totals = {r.quality: r.n for r in marks.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    chosen = bounded_sample(marks, "quality", rows_per_class).select("doc_id", "quality")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # rows_per_class rows of two classes at most
    sample = sample.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rarity = term_rarity(docs) if len(totals) == 2 else None

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part in _parts(batches, "text"):
            counts = term_counts(part.column("text").to_pylist())
            rows += zip(part.column("doc_id").to_pylist(), part.column("quality").to_pylist(), counts)
        rows.sort(key=lambda r: r[0])
        marked = np.array([r[1] for r in rows])
        if len(set(marked.tolist())) < 2:
            model = _constant(float(marked[0]) if rows else 0.0)
        else:
            model = learn_model(rarity, np.stack([r[2] for r in rows]), marked, totals[1] / (totals[0] + totals[1]))
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    # One task learns; its input is bounded by rows_per_class.
    blob = sample.repartition(1).mapInArrow(learn, "model binary").collect()
    return pickle.loads(blob[0].model) if blob else _constant(0.0)


def quality(
    docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ("doc_id",), rows_per_class: int = ROWS_PER_CLASS
) -> DataFrame:
    """The ``carry`` columns of every row with ``score``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows_per_class))
    rows = docs.select(*carry, F.col("text").alias("_text"))
    out = T.StructType([*docs.select(*carry).schema.fields, T.StructField("score", T.DoubleType())])
    names = out.names

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, "_text"):
            scores = model.value.scores(term_counts(part.column("_text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scores.astype(np.float64))], names=names)

    return rows.mapInArrow(predict, out)


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted)
