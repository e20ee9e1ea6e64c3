"""Toxicity scores by a convolutional text classifier.

A word and its n-grams of code points, at all places, are hashed to rows of an embedding table, whose sum stands for the
word; forms seen in fewer than ``SEEN_IN`` texts learned from stand for nothing, so that no single text is learned by heart.
Long words are several overlapping pieces, letters of scripts without blanks are words of their own, so every part of a text
reaches the filters. Filters of several widths slide over the words, each keeps its highest answer over the whole text, and
a logistic layer reads these. Training (Adam, in numpy) reads every labelled row, whole, in tasks that Spark deals out: in
each of ``EPOCHS`` rounds all tasks start from one model, learn from rows of their own, and what they changed is averaged (an
embedding row over the tasks that met it). A task goes through its rows ``EPOCHS`` times if they are few, and at least
``PASSES`` times: a round takes the next of some shares of them. A fifth of all labelled rows is
set aside to calibrate, counted by language in steps of the logit: it is shifted so that 0.5 is the best cut, and each
language gets a threshold of its own (``flagged``), shrunk to 0.5 where it has few rows. The language never enters a
score. Scoring is a map over the scan; the model (a few MB, fixed size) is broadcast.

Defined results: null, empty and wordless texts get the score of no words; several labels of a document count as toxic if
one is; null labels are ignored; with labels of one class only the score is 1 or 0 for all, with none 0; rows that repeat
score alike; only doc_id, text and lang of the documents are read.
"""

from __future__ import annotations

import copy
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import _BASE, Spans, _powers, blocks, documents, held_out, mix64, side, text_bytes, text_or_empty, written

BITS = 15
DIM = 12
FILTERS = 12
WIDTHS = (1, 2, 3)
PIECE = 8
GRAMS = (3, 4)
SEEN_IN = 4
TASK_ROWS = 1600
EPOCHS = 8
PASSES = 2
BATCH = 32
RATE = 0.01
DECAY = 1e-5
STEP = 1 / 64

_PAD = 1 << BITS
_GAP = max(WIDTHS)
_STEP = PIECE - max(GRAMS) + 1  # pieces of a long word overlap, so that every n-gram stands in one
COLUMNS = 1 + sum(PIECE - n + 1 for n in GRAMS)
_SLOTS = 44
_PLANE = 1 << 16
_BLOCKS = 64
# Scripts written without blanks, by Unicode block: a letter of theirs is a word of its own.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF))


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point below 65536: 0 no letter, 1 letter or mark inside words, 2 word of its own; and its small form."""
    kind, small = np.zeros(_PLANE, np.uint8), np.arange(_PLANE, dtype=np.uint32)
    for c in range(_PLANE):
        s = chr(c)
        if s.isalpha() or unicodedata.category(s) in ("Mn", "Mc"):
            kind[c] = 2 if any(a <= c <= b for a, b in _UNSPACED) else 1
            if len(s.lower()) == 1:
                small[c] = ord(s.lower())
    return kind, small


_KIND, _SMALL = _letters()
_CODES = mix64(np.arange(1, _PLANE + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Points(Spans):
    """Hashes of ranges of code points."""

    def __init__(self, points: np.ndarray):
        codes = _CODES[np.minimum(points, _PLANE - 1)]
        rare = points >= _PLANE
        if rare.any():
            codes[rare] = mix64(points[rare].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        n = len(points)
        self.inverse = _powers(n, pow(_BASE, -1, 1 << 64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * _powers(n, _BASE)[:n], out=self.sums[1:])


def _pieces(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words cut into pieces of at most ``PIECE`` code points, and where each word's first piece is among them."""
    count = 1 + np.maximum(-(-(ends - starts - PIECE) // _STEP), 0)
    first = np.cumsum(count) - count
    begin = np.repeat(starts, count) + (np.arange(int(count.sum())) - np.repeat(first, count)) * _STEP
    return begin, np.minimum(begin + PIECE, np.repeat(ends, count)), first


def word_hashes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every word and of its n-grams (a column each), ``_GAP`` rows of 0 after each text; the first row of
    each text and the one after its last (a text without words keeps one pad).

    A word is a run of letters, in small letters. A word of more than ``PIECE`` code points has a row for each of its
    overlapping pieces, the first with the hash of the whole word; a letter of a script without blanks is a word.
    """
    n = len(offsets) - 1
    if len(body):
        points = np.frombuffer(body.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])[offsets]
        near = np.minimum(points, _PLANE - 1)
        kind = np.where(points < _PLANE, _KIND[near], np.uint8(2))
        low = np.where(points < _PLANE, _SMALL[near], points)
        edge = np.zeros(len(points) + 1, bool)
        edge[bounds] = True
        apart = edge[:-1] | (kind == 2)
        apart[1:] |= (kind[1:] != kind[:-1])
        inside = kind > 0
        starts = np.flatnonzero(inside & apart)
        ends = np.flatnonzero(inside & np.concatenate([apart[1:], [True]])) + 1
        spans = _Points(low)
        begin, end, first = _pieces(starts, ends)
        words = np.zeros((len(begin), COLUMNS), np.uint64)
        words[:, 0] = spans.hash(begin, end)
        words[first, 0] = spans.hash(starts, ends)
        column = 1
        for size in GRAMS:
            mark = np.uint64(0x5851F42D4C957F2D * size % (1 << 64))
            for k in range(PIECE - size + 1):
                own = np.flatnonzero(begin + k + size <= end)
                words[own, column] = spans.hash(begin[own] + k, begin[own] + k + size) ^ mark
                column += 1
        counts = np.diff(np.searchsorted(begin, bounds))
    else:
        words, counts = np.zeros((0, COLUMNS), np.uint64), np.zeros(n, np.int64)
    first = np.cumsum(counts + _GAP) - (counts + _GAP)
    out = np.zeros((int((counts + _GAP).sum()), COLUMNS), np.uint64)
    out[np.arange(int(counts.sum())) + np.repeat(np.arange(n) * _GAP, counts)] = words
    return out, first, first + np.maximum(counts, 1)


@dataclass
class Model:
    table: np.ndarray  # (buckets + 1) x DIM; the pad's row is zero
    known: np.ndarray  # whether a slot of hashes was seen in enough texts
    filters: list[np.ndarray]  # width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def buckets(self, hashes: np.ndarray) -> np.ndarray:
        own = ((hashes >> np.uint64(_SLOTS - BITS)) & np.uint64(_PAD - 1)).astype(np.int32)
        return np.where(self.known[(hashes >> np.uint64(_SLOTS)).astype(np.int32)] & (hashes != 0), own, _PAD)

    def vectors(self, words: np.ndarray) -> np.ndarray:
        out = self.table[words[..., 0]]
        for c in range(1, COLUMNS):
            out += self.table[words[..., c]]
        return out

    def answers(self, words: np.ndarray) -> np.ndarray:
        """Every filter's answer at every position."""
        n = len(words)
        vectors = self.vectors(words)
        parts = []
        for bank in self.filters:
            reach = vectors @ bank[0]
            for o in range(1, len(bank)):
                reach[: n - o] += vectors[o:] @ bank[o]
            parts.append(reach)
        return np.concatenate(parts, axis=1)

    def logits(self, hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first), 50.0 if self.constant else -50.0)
        words = self.buckets(hashes)
        cuts = np.stack([first, end], axis=1).reshape(-1)
        peaks = np.maximum.reduceat(self.answers(words), cuts, axis=0)[::2]
        return np.maximum(peaks + self.bias, 0) @ self.out[:-1] + self.out[-1] + self.shift


def _constant(value: float) -> Model:
    return Model(np.zeros((1, 1)), np.zeros(0, bool), [], np.zeros(0), np.zeros(1), constant=value)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def seen_slots(texts: list[np.ndarray], least: int = SEEN_IN) -> np.ndarray:
    counts = np.zeros(1 << (64 - _SLOTS), np.int32)
    for hashes in texts:
        counts[np.unique(hashes[hashes != 0] >> np.uint64(_SLOTS)).astype(np.int64)] += 1
    return counts >= least


def _start(known: np.ndarray, rng: np.random.Generator) -> Model:
    m = Model(
        rng.normal(0, 0.1, (_PAD + 1, DIM)).astype(np.float32),
        known,
        [rng.normal(0, 0.4 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        rng.normal(0, 0.3, FILTERS * len(WIDTHS) + 1).astype(np.float32),
    )
    m.table[_PAD] = 0
    return m


class Learner:
    """Adam on the parameters of a model, which it changes in place."""

    def __init__(self, m: Model, rng: np.random.Generator):
        self.m, self.rng, self.step = m, rng, 0
        self.params = [m.table, *m.filters, m.bias, m.out]
        self.means, self.squares = [np.zeros_like(x) for x in self.params], [np.zeros_like(x) for x in self.params]

    def epoch(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        """texts: the buckets of every text."""
        m = self.m
        order = self.rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            chosen = order[a : a + BATCH]
            counts = np.array([len(texts[i]) for i in chosen])
            words = np.full((int((counts + _GAP).sum()), COLUMNS), _PAD, np.int64)
            first = np.cumsum(counts + _GAP) - (counts + _GAP)
            for i, start in zip(chosen, first):
                words[start : start + len(texts[i])] = texts[i]
            reach = m.answers(words)
            at = np.stack([s + reach[s : s + max(c, 1)].argmax(axis=0) for s, c in zip(first, counts)])
            peaks = np.take_along_axis(reach, at, axis=0) + m.bias
            hidden = np.maximum(peaks, 0)
            error = (_sigmoid(hidden @ m.out[:-1] + m.out[-1]) - labels[chosen]) / len(chosen)
            back = (error[:, None] * m.out[:-1]) * (peaks > 0)
            grads = [np.zeros_like(m.table)]
            for k, bank in enumerate(m.filters):
                own, places = back[:, k * FILTERS : (k + 1) * FILTERS], at[:, k * FILTERS : (k + 1) * FILTERS]
                grad = np.zeros_like(bank)
                for o in range(len(bank)):
                    seen = words[np.minimum(places + o, len(words) - 1)]
                    grad[o] = np.einsum("bfd,bf->df", m.vectors(seen), own)
                    pull = (own[:, :, None] * bank[o].T[None]).reshape(-1, DIM)
                    for c in range(COLUMNS):
                        np.add.at(grads[0], seen[..., c].reshape(-1), pull)
                grads.append(grad)
            grads[0][_PAD] = 0
            grads += [back.sum(axis=0), np.concatenate([hidden.T @ error, [error.sum()]]).astype(np.float32)]
            self.step += 1
            for x, g, mean, square in zip(self.params, grads, self.means, self.squares):
                mean += 0.1 * (g - mean)
                square += 0.01 * (g * g - square)
                x -= RATE * ((mean / (1 - 0.9**self.step)) / (np.sqrt(square / (1 - 0.99**self.step)) + 1e-8) + DECAY * x)


def train(hashed: list[tuple[np.ndarray, int]], seed: int = 3) -> Model:
    """hashed: (word hashes without pads, label)."""
    rng = np.random.default_rng(seed)
    m = _start(seen_slots([h for h, _ in hashed]), rng)
    texts, learner = [m.buckets(h) for h, _ in hashed], Learner(m, rng)
    for _ in range(EPOCHS):
        learner.epoch(texts, np.array([y for _, y in hashed], np.float32))
    return m


def _best_cut(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The logit between two neighbours that makes the fewest weighted errors; the middle one of equal cuts."""
    order = np.argsort(logits)
    z, y, w = logits[order], labels[order], weights[order]
    errors = np.concatenate([[0], np.cumsum(w * y)]) + np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0]])
    places = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    best = np.flatnonzero(errors <= errors.min() + 1e-9)
    return float(places[best[len(best) // 2]])


def calibrate(m: Model, logits: np.ndarray, labels: np.ndarray, langs: list, counts: np.ndarray) -> None:
    """Shift so that 0.5 is the best cut of the counted rows; thresholds by language around it."""
    m.shift = -_best_cut(logits, labels, counts)
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        rows = counts[own].sum()
        if 0 < (counts[own] * labels[own]).sum() < rows:
            cut = _best_cut(logits[own] + m.shift, labels[own], counts[own])
            m.thresholds[lang] = float(_sigmoid(np.array(cut * rows / (rows + 100.0))))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Blocks of rows with the word hashes of each text, without pads."""
    for block in blocks(batches):
        words, first, _ = word_hashes(*text_bytes(block.column("text")))
        yield block, [words[a:b] for a, b in zip(first, np.concatenate([first[1:], [len(words)]]) - _GAP)]


def _in_blocks(vector: np.ndarray) -> pa.RecordBatch:
    parts = [x.astype(np.float32).tobytes() for x in np.array_split(vector, _BLOCKS)]
    columns = [pa.array(range(_BLOCKS), pa.int32()), pa.array([TaskContext.get().partitionId()] * _BLOCKS, pa.int32())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())], names=["block", "task", "vector"])


def _sum(vectors: DataFrame) -> np.ndarray | None:
    """The sum of what all tasks made by ``_in_blocks``: one vector, of fixed size."""

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = sum(np.frombuffer(v, np.float32).astype(np.float64) for v in table.column("vector").to_pylist())
        return pa.table({"block": table.column("block")[:1], "vector": pa.array([total.tobytes()], pa.binary())})

    found = vectors.groupBy("block").applyInArrow(add, "block int, vector binary").collect()
    return np.concatenate([np.frombuffer(r.vector) for r in sorted(found)]) if found else None


_VECTOR = "block int, task int, vector binary"


def _known(rows: DataFrame) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << (64 - _SLOTS), np.int32)
        for _, texts in _hashed(batches):
            for hashes in texts:
                counts[np.unique(hashes[hashes != 0] >> np.uint64(_SLOTS)).astype(np.int64)] += 1
        yield _in_blocks(np.minimum(counts, SEEN_IN))

    return _sum(rows.select("text").mapInArrow(count, _VECTOR)) >= SEEN_IN


def _round(rows: DataFrame, m: Model, number: int) -> None:
    """One round: tasks learn from ``rows`` apart, the model takes the mean of their changes."""
    start = rows.sparkSession.sparkContext.broadcast(m)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old = start.value
        learner = Learner(copy.deepcopy(old), np.random.default_rng(number))
        for block, texts in _hashed(batches):
            learner.epoch([old.buckets(h) for h in texts], block.column("toxic").to_numpy().astype(np.float32))
        if learner.step:
            before = Learner(old, learner.rng).params
            changes = [(new - x).reshape(-1) for new, x in zip(learner.params, before)]
            met = (learner.squares[0] > 0).any(axis=1)
            changes[0] = ((learner.params[0] - before[0]) * met[:, None]).reshape(-1)
            yield _in_blocks(np.concatenate([*changes, met, [1.0]]))

    found = _sum(rows.select("text", "toxic").mapInArrow(learn, _VECTOR))
    start.unpersist()
    if found is None:
        return
    tasks, met = found[-1], found[-_PAD - 2 : -1]
    at = 0
    for x in (m.table, *m.filters, m.bias, m.out):
        change = found[at : at + x.size].reshape(x.shape)
        x += (change / (np.maximum(met, 1)[:, None] if x is m.table else tasks)).astype(np.float32)
        at += x.size


def fit(docs: DataFrame, labels: DataFrame, task_rows: int = TASK_ROWS) -> Model:
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    marks = written(marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    part = F.pmod(F.xxhash64("doc_id", text_or_empty()), F.lit(1 << 20)).cast("int").alias("part")
    rows = docs.select("doc_id", "text", "lang").join(side(marks, 16), "doc_id")
    rows = written(rows.select("text", "lang", "toxic", part), "toxic-rows")
    aside = F.pmod("part", F.lit(5)) == 4
    totals = rows.groupBy(aside.alias("aside"), "toxic").agg(F.count("*").alias("n")).collect()
    classes = {r.toxic for r in totals}
    if len(classes) < 2:
        return _constant(float(classes.pop()) if classes else 0.0)
    both = len({r.toxic for r in totals if not r.aside}) == 2
    learned = rows.filter(~aside) if both else rows
    n = sum(r.n for r in totals if not (both and r.aside))
    # no more tasks than have rows enough for several rounds: of many rows each is learned from PASSES times
    tasks = max(1, min(rows.rdd.getNumPartitions(), n * PASSES // (task_rows * EPOCHS)))
    shares = max(1, min(EPOCHS // PASSES, n // (tasks * task_rows)))
    learned = learned.coalesce(tasks)
    m = _start(_known(learned), np.random.default_rng(3))
    for number in range(EPOCHS):
        _round(learned.filter(F.pmod(F.floor(F.col("part") / 5), F.lit(shares)) == number % shares), m, number)
    if both and len({r.toxic for r in totals if r.aside}) == 2:
        _calibrate_on(rows.filter(aside), m)
    return m


def _calibrate_on(rows: DataFrame, m: Model) -> None:
    """``calibrate`` by the number of rows of each language (they are few), label and step of the logit."""
    model = rows.sparkSession.sparkContext.broadcast(m)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=1 << 18):
            z = model.value.logits(*word_hashes(*text_bytes(block.column("text"))))
            steps = pa.array(np.floor(np.clip(z, -50, 50) / STEP).astype(np.int32))
            arrays = [block.column("lang"), block.column("toxic"), steps]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "toxic", "step"])

    scored = rows.select("text", "lang", "toxic").mapInArrow(score, "lang string, toxic int, step int")
    found = sorted(scored.groupBy("lang", "toxic", "step").agg(F.count("*").alias("n")).collect(), key=str)
    model.unpersist()
    logits = np.array([(r.step + 0.5) * STEP for r in found])
    labels, counts = np.array([r.toxic for r in found]), np.array([float(r.n) for r in found])
    calibrate(m, logits, labels, [r.lang for r in found], counts)


def toxicity(
    docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ("doc_id",), task_rows: int = TASK_ROWS
) -> DataFrame:
    """The ``carry`` columns of every row with ``score`` and ``flagged`` (score against its language's threshold)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, task_rows))
    rows = docs.select(*carry, F.col("lang").alias("_lang"), F.col("text").alias("_text"))
    added = [T.StructField("score", T.DoubleType()), T.StructField("flagged", T.BooleanType())]
    out = T.StructType([*docs.select(*carry).schema.fields, *added])
    names = out.names

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for block in blocks(batches, "_text", limit=1 << 18):
            scores = _sigmoid(m.logits(*word_hashes(*text_bytes(block.column("_text")))).astype(np.float64))
            cuts = np.array([m.thresholds.get(x, 0.5) for x in block.column("_lang").to_pylist()])
            arrays = [*block.columns[:-2], pa.array(scores), pa.array(scores >= cuts)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(predict, out)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted)
