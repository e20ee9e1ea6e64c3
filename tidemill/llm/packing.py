"""Packing documents into fixed windows of tokens, in order, by dynamic programming.

The token stream of a task's documents is cut into sequences of at most ``width`` tokens. Cut candidates are the ends
of documents (free), ends of sentences (a small truncation penalty) and, where a stretch has neither, places in between
(a larger one). With p the position of a candidate, c its
penalty and s a small charge per sequence, the cheapest packing up to candidate j is

    f(j) = c(j) + s + min over i with p(j) - p(i) <= width of f(i) + width - (p(j) - p(i))

The part that depends on i alone, f(i) + p(i), is minimal at the head of a monotone queue over the sliding range of i,
so a candidate costs constant time. A sequence whose length is a power of two needs no padding: those transitions are
looked up beside the queue. The remainder at the end of a task may be cut at its binary digits for that reason.

Scale: one map over the scan, no shuffle. A task holds one block of tokens (``BLOCK_TOKENS``); all but the last
sequences of a block are final and its rest moves to the next block, so long documents run through any number of
blocks. Word pieces are looked up in a bounded table of words already seen, which drops those that do not
recur; new words are encoded many at a time.

Defined results: a null text counts as empty, and every document ends with the separator, so an empty one is the
separator alone; rows that repeat are packed again; documents keep the order of the input within a partition; an empty
table gives no rows; no column but doc_id and text is read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import blocks, documents

WIDTH = 2048
SEPARATOR = 1
SENTENCE_PENALTY = 8
FORCED_PENALTY = 24
SEQUENCE_PENALTY = 16
STRIDE = 64
BLOCK_TOKENS = 1 << 20
KNOWN_WORDS = 800_000
TEXT_BYTES = 4 << 20
LEAST_POWER = 5
# The split pattern of the vocabulary's own file, used only to count the pieces of a word.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """Token ids of whole texts, equal to those of the tokenizer.

    The vocabulary drops white space and no merge crosses it, so a text's ids are those of its blank-separated words,
    one after another. New words are encoded joined by spaces; the end-of-word pieces in the result must be as many as
    the words should have, otherwise each word is encoded by itself.
    """

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.stops = np.zeros(len(self.ends), bool)
        for piece, token in vocabulary.items():
            self.ends[token] = piece.endswith("</w>")
            self.stops[token] = piece.endswith("</w>") and piece[:-4].rstrip("\"')]")[-1:] in (".", "!", "?")
        self.pieces = regex.compile(PIECES)
        self.limit = known_words
        self.index: dict[bytes, int] = {}
        self.starts, self.ids, self.size = [np.zeros(1, np.int64)], [np.zeros(0, np.uint32)], 0
        self.uses = np.zeros(0, np.int32)

    def forget(self) -> None:
        """Drops the words that did not recur since the last time, and more only if over half the table did."""
        words, keep = list(self.index), np.flatnonzero(self.uses > 1)
        if len(keep) > self.limit // 2:
            keep = np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[: self.limit // 2]])
        starts, pool = self.starts[0], self.ids[0]
        lengths = starts[keep + 1] - starts[keep]
        ends = np.cumsum(lengths)
        places = np.repeat(starts[keep] - (ends - lengths), lengths) + np.arange(lengths.sum())
        self.index = {words[i]: n for n, i in enumerate(keep.tolist())}
        self.starts, self.ids, self.size = [np.concatenate([[0], ends])], [pool[places]], len(places)
        self.uses = np.zeros(len(keep), np.int32)

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        counts = [1 if (t := text.lower()).isalpha() else len(self.pieces.findall(t)) for text in texts]
        for a in range(0, len(words), 2000):
            self._add(words[a : a + 2000], texts[a : a + 2000], np.array(counts[a : a + 2000]))

    def _add(self, words, texts, counts) -> None:
        joined = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends[joined])
        if len(last) == counts.sum() and (counts > 0).all() and len(last) and last[-1] == len(joined) - 1:
            stops = last[np.cumsum(counts) - 1] + 1
            lengths = np.diff(np.concatenate([[0], stops]))
        else:
            each = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            lengths = np.array([len(e.ids) for e in each])
            joined = np.array([i for e in each for i in e.ids], np.uint32)
        first = len(self.index)
        self.index.update(zip(words, range(first, first + len(words))))
        self.starts.append(self.size + np.cumsum(lengths))
        self.ids.append(joined)
        self.size += len(joined)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, without separators, and the n + 1 offsets of the texts."""
        if len(self.index) > self.limit:
            self.forget()
        # The vocabulary is lower case, so forms that differ in A-Z alone are one word; a special token's name is not.
        words = [(t if b"<|" in t else t.lower()).split() for t in texts]
        flat = [w for own in words for w in own]
        new = [w for w in dict.fromkeys(flat) if w not in self.index]
        if new:
            self._learn(new)
            self.starts, self.ids = [np.concatenate(self.starts)], [np.concatenate(self.ids)]
            self.uses = np.concatenate([self.uses, np.zeros(len(self.index) - len(self.uses), np.int32)])
        offsets = np.zeros(len(texts) + 1, np.int64)
        if not flat:
            return np.zeros(0, np.uint32), offsets
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        self.uses += np.bincount(at, minlength=len(self.uses)).astype(np.int32)
        starts, pool = self.starts[0], self.ids[0]
        begin, lengths = starts[at], starts[at + 1] - starts[at]
        ends = np.cumsum(lengths)
        ids = pool[np.repeat(begin - (ends - lengths), lengths) + np.arange(ends[-1])]
        np.cumsum([len(w) for w in words], out=offsets[1:])
        offsets = np.concatenate([[0], ends])[offsets]
        return ids, offsets


_LOADED: dict[tuple[str, int], WordTokens] = {}


def word_tokens(path: str, known_words: int) -> WordTokens:
    """One table of words for all tasks that a Python worker runs."""
    if (path, known_words) not in _LOADED:
        _LOADED[path, known_words] = WordTokens(path, known_words)
    return _LOADED[path, known_words]


def candidates(doc_ends: np.ndarray, stops: np.ndarray, n: int, width: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions in (0, n] and their penalties. Position p stands after the p-th token of the block."""
    at = np.concatenate([doc_ends, stops, [0, n]])
    cost = np.concatenate([np.zeros(len(doc_ends)), np.full(len(stops), SENTENCE_PENALTY), [0, FORCED_PENALTY]])
    order = np.lexsort((cost, at))
    at, cost = at[order], cost[order]
    first = np.concatenate([[True], at[1:] != at[:-1]])
    at, cost = at[first], cost[first]
    gaps = np.diff(at)
    more = [np.arange(at[i] + STRIDE, at[i + 1], STRIDE) for i in np.flatnonzero(gaps > width)]
    if last and n:
        # Binary digits of what a window leaves at the end, so that the remainder can do without padding.
        rest, here, digits = n % width, n - n % width, []
        for k in range(int(width).bit_length() - 2, LEAST_POWER - 1, -1):
            if rest & (1 << k):
                here += 1 << k
                digits.append(here)
        more.append(np.array(digits, np.int64))
    if more:
        extra = np.setdiff1d(np.concatenate(more), at)
        order = np.argsort(np.concatenate([at, extra]), kind="stable")
        cost = np.concatenate([cost, np.full(len(extra), FORCED_PENALTY)])[order]
        at = np.concatenate([at, extra])[order]
    return at.astype(np.int64), cost


def cut(at: np.ndarray, cost: np.ndarray, width: int) -> list[int]:
    """Positions of the cheapest cuts, first 0 and last ``at[-1]``."""
    n = len(at)
    extra: dict[int, list[int]] = {}
    for k in range(LEAST_POWER, int(width).bit_length() - 1):
        found = np.searchsorted(at, at - (1 << k))
        hit = (found < n) & (at[np.minimum(found, n - 1)] == at - (1 << k))
        for j in np.flatnonzero(hit).tolist():
            extra.setdefault(j, []).append(int(found[j]))
    places, costs = at.tolist(), cost.tolist()
    best, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int, int]] = deque([(float(places[0]), places[0], 0)])
    for j in range(1, n):
        p = places[j]
        while queue[0][1] < p - width:
            queue.popleft()
        head = queue[0]
        value, origin = head[0] + width - p, head[2]
        if j in extra:
            for i in extra[j]:
                if best[i] < value:
                    value, origin = best[i], i
        value += costs[j] + SEQUENCE_PENALTY
        best[j], back[j] = value, origin
        key = value + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    path, j = [places[-1]], n - 1
    while j:
        j = back[j]
        path.append(places[j])
    return path[::-1]


class Packer:
    """Packs the documents of one task; yields rows (document, start, length, crc32, doc_tokens, sequence, offset)."""

    def __init__(self, words: WordTokens, width: int, base: int):
        self.words, self.width, self.sequence = words, width, base
        self.ids = np.zeros(0, np.uint32)
        self.docs: list[tuple] = []  # (document, first position in the block, whole length, tokens of it already packed)

    def add(self, keys: list, texts: list[bytes]) -> Iterator[tuple]:
        ids, offsets = self.words.encode(texts)
        lengths = np.diff(offsets) + 1
        ends = np.cumsum(lengths)
        out = np.empty(int(ends[-1]), np.uint32)
        body = np.ones(len(out), bool)
        body[ends - 1] = False
        out[body], out[~body] = ids, SEPARATOR
        base = len(self.ids)
        self.docs += zip(keys, (base + ends - lengths).tolist(), lengths.tolist(), [0] * len(keys))
        self.ids = np.concatenate([self.ids, out])
        if len(self.ids) >= BLOCK_TOKENS:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[tuple]:
        n = len(self.ids)
        if not n:
            return
        doc_ends = np.array([first + size - done for _, first, size, done in self.docs], np.int64)
        stops = np.flatnonzero(self.words.stops[self.ids]) + 1
        cuts = cut(*candidates(doc_ends, stops, n, self.width, last), self.width)
        if not last:
            keep = next(i for i in range(len(cuts) - 1, -1, -1) if cuts[i] <= n - 8 * self.width)
            cuts = cuts[: keep + 1]
        at, i = 0, 0
        for a, b in zip(cuts, cuts[1:]):
            while a < b:
                key, first, size, done = self.docs[i]
                end = min(b, first + size - done)
                piece = np.ascontiguousarray(self.ids[a:end], "<u4")
                yield key, done + a - first, end - a, zlib.crc32(piece), size, self.sequence, a - at
                if end == first + size - done:
                    i += 1
                a = end
            self.sequence, at = self.sequence + 1, b
        done_to = cuts[-1]
        rest = []
        for key, first, size, done in self.docs[i:]:
            packed = max(0, done_to - first)
            rest.append((key, max(first - done_to, 0), size, done + packed))
        self.docs, self.ids = rest, self.ids[done_to:].copy()


_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def pack(
    docs: DataFrame,
    width: int = WIDTH,
    vocabulary: str | None = None,
    known_words: int = KNOWN_WORDS,
    text_bytes: int = TEXT_BYTES,
) -> DataFrame:
    """One row per piece; ``sequence_id`` counts within a partition, whose number fills its upper bits.

    ``known_words`` bounds the table of words a worker keeps and ``text_bytes`` the texts it handles at once. Both trade
    memory for time where executors hold other work as well; the rows do not depend on them but for where blocks end.
    """
    path = vocabulary or vocabulary_path()
    names = [c.split()[0] for c in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(word_tokens(path, known_words), width, TaskContext.get().partitionId() << 36)

        def shaped(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        for block in blocks(batches, limit=text_bytes):
            texts = [t or b"" for t in block.column("text").cast(pa.binary()).to_pylist()]
            if rows := list(packer.add(block.column("doc_id").to_pylist(), texts)):
                yield shaped(rows)
        if rows := list(packer.flush(last=True)):
            yield shaped(rows)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
