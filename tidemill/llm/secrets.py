"""Secret scan: candidate strings, with a random forest that removes the false findings.

Candidates are runs of at least ``LEAST`` key characters that hold a digit or are assigned a value (``name = value``), and
every value assigned to a name with a credential word in it, quoted or up to the next blank, of any length and signs. Each is
described by its length, shares of character classes, class changes, entropy, the mean log-probability of its character
transitions under ordinary words, the share of it covered by dictionary words, what stands around it (quotes, assignment,
credential words before, hashes of the neighbouring words) and its path (the source column).

The forest is trained from labelled findings (doc_id, start, label), bounded by ``rows_per_class``. Each tree is one task.
Dictionary and transitions come from all texts: the dictionary holds every word of 3 to ``LONGEST`` letters that stands in two
texts or more, the transitions are a 27 x 27 table of letter pairs over these words, weighted by their texts. The dictionary
is broadcast where its counted size fits; beyond that the substrings of the candidates are joined with it and every candidate
gets its own words. Forest and findings sample are of bounded size and broadcast; scoring is a map over the scan.

Without reviewed findings (``findings=None``) labels are made by rule: a provider's key format, or a value of some entropy
assigned right after a credential word, is true; numbers and ordinary words joined by signs are false, unless a credential
word stands before the assignment; what the rule cannot judge is not labelled. Only documents outside the held-out fifth count.

Defined results: null and empty texts have no candidates; several labels of one finding count as true if one is; with labels
of one class only all scores are 1 or 0, with none 0; rows that repeat are scanned again; an empty table gives no rows; only
doc_id, text and source are read.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import BROADCAST_BYTES, blocks, bounded_sample, documents, fits, held_out, row_hash, written

LEAST = 12
LONGEST = 16
ROWS_PER_CLASS = 1000
TREES = 24
DEPTH = 8
LEAF = 3

_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{%d,}={0,2}(?![A-Za-z0-9+/_-])|(?<=[=:])[A-Za-z0-9+/_-]{%d,}={0,2}" % (LEAST, LEAST))
_ASSIGNED = re.compile(r"[=:]\s*[\"']?$")
_WORDS = re.compile(r"[^\W_]+")
_LETTERS = re.compile(r"(?<!\w)[a-z]{3,}(?!\w)")  # whole words: parts of random strings would fill the dictionary
CREDENTIALS = "password passwd pwd secret token key apikey auth credential bearer access private".split()
PROVIDER_KEY = re.compile(r"AKIA[0-9A-Z]{16}$|gh[pousr]_[0-9A-Za-z]{36}$|xox[abprs]-[0-9A-Za-z-]{20,}$|AIza[0-9A-Za-z_-]{35}$")
_CREDENTIAL = re.compile("|".join(sorted(CREDENTIALS, key=len, reverse=True)), re.I)
# What follows a credential word up to the value: the rest of the name, its quote or bracket, the sign, an opening quote.
_VALUE = re.compile(
    r"""[\w.-]{0,64}["'\]]{0,2}[ \t]*(?::=|=>|[=:](?!=))[ \t]*(?:"((?:[^"\\\n]|\\.)+)"|'((?:[^'\\\n]|\\.)+)'|["']?((?:(?!&\w+=)[^\s])+))"""
)
_SEGMENT = r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*\d{0,4}|[A-Z]+\d{0,4}|\d{1,4})"
_ORDINARY = re.compile(rf"[\d+/_=-]+|{_SEGMENT}(?:[+/_=-]+{_SEGMENT})*[+/_=-]*")
_PATHS = re.compile(r"test|example|sample|mock|docs?\b|fixture", re.I)

FEATURES = (
    "length digits upper lower other changes entropy transitions coverage hex numeric quoted assigned credential "
    "word_before word_after path_kind path_hash"
).split()


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def _entropy(value: str) -> float:
    counts = np.array([value.count(c) for c in set(value)]) / len(value)
    return float(-(counts * np.log2(counts)).sum())


class Language:
    """Dictionary and character transitions of ordinary words."""

    def __init__(self, words: set[str], pairs: dict[tuple[int, int], int]):
        self.words = words
        counts = np.ones((27, 27))
        for (a, b), times in pairs.items():
            counts[a, b] += times
        self.logs = np.log(counts / counts.sum(axis=1, keepdims=True))

    def transitions(self, value: str) -> float:
        codes = [ord(c) - 97 if "a" <= c <= "z" else 26 for c in value.lower()]
        return float(np.mean([self.logs[a, b] for a, b in zip(codes, codes[1:])])) if len(codes) > 1 else 0.0

    def coverage(self, value: str, words: set[str] | None = None) -> float:
        """Share of the characters that a greedy longest match with dictionary words (3 letters or more) covers."""
        low, at, covered = value.lower(), 0, 0
        words = self.words if words is None else words
        while at < len(low):
            size = next((n for n in range(min(LONGEST, len(low) - at), 2, -1) if low[at : at + n] in words), 0)
            covered, at = covered + size, at + max(size, 1)
        return covered / len(low)


def substrings(value: str) -> Iterator[str]:
    """All parts of a candidate that may be a dictionary word."""
    for run in re.finditer("[a-z]{3,}", value.lower()):
        for i in range(run.start(), run.end() - 2):
            for n in range(3, min(LONGEST, run.end() - i) + 1):
                yield run.string[i : i + n]


def _credential_values(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values assigned to names with a credential word, in order, not overlapping."""
    found, end = [], 0
    for word in _CREDENTIAL.finditer(text):
        left, right = text[word.start() - 1 : word.start()], text[word.end() : word.end() + 2]
        if word.start() < end or (left.isalpha() and not (left.islower() and word[0][0].isupper())):
            continue  # inside another word, as in "monkey"
        if right[:1].isalpha() and not (right[0] in "sS" and not right[1:].isalpha()) and not (word[0][-1].islower() and right[0].isupper()):
            continue  # the beginning of another word, as in "keyboard"
        if m := _VALUE.match(text, word.end()):
            group = next(g for g in (1, 2, 3) if m[g] is not None)
            start, stop = m.span(group)
            if group == 3:
                stop = start + len(m[3].rstrip(",;.)]}>\"'`"))
            if stop > start:
                found.append((start, stop))
                end = stop
    return found


def find(text: str | None) -> list[tuple[int, str, str, str, bool]]:
    """(start, value, text before, text after, assigned) of every candidate."""
    if not text:
        return []
    spans = [(a, b, True) for a, b in _credential_values(text)]
    values, at = len(spans), 0
    for m in _CANDIDATE.finditer(text):
        while at < values and spans[at][1] <= m.start():
            at += 1
        if at < values and spans[at][0] < m.end():  # a part of such a value
            continue
        assigned = _ASSIGNED.search(text[max(0, m.start() - 48) : m.start()]) is not None
        if assigned or any(c.isdigit() for c in m[0]):
            spans.append((m.start(), m.end(), assigned))
    return [(a, text[a:b], text[max(0, a - 48) : a], text[b : b + 32], assigned) for a, b, assigned in sorted(spans)]


def describe(value: str, before: str, after: str, assigned: bool, path: str | None, language: Language) -> list[float]:
    kinds = [_kind(c) for c in value]
    n = len(value)
    words = [w.lower() for w in _WORDS.findall(before)]
    following = _WORDS.search(after)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    return [
        n, *(kinds.count(k) / n for k in range(4)), changes / n, _entropy(value), language.transitions(value),
        language.coverage(value), float(re.fullmatch("[0-9a-f]+|[0-9A-F]+", value) is not None), float(value.isdigit()),
        float(before[-1:] in "\"'" and bool(before)), float(assigned), float(any(w in CREDENTIALS for w in words[-2:])),
        zlib.crc32(words[-1].encode()) % 64 if words else -1, zlib.crc32(following[0].lower().encode()) % 64 if following else -1,
        float(bool(path) and _PATHS.search(path) is not None), zlib.crc32((path or "").encode()) % 64,
    ]


def rule_label(value: str, before: str, assigned: bool) -> bool:
    words = [w.lower() for w in _WORDS.findall(before)]
    mixed = len(value) >= LEAST or (any(map(str.isdigit, value)) and any(map(str.isalpha, value)))
    named = assigned and words[-1:] != [] and words[-1] in CREDENTIALS
    return bool(PROVIDER_KEY.match(value)) or (named and mixed and " " not in value and _entropy(value) > 2.5)


def rule_judges(value: str, before: str, assigned: bool) -> bool:
    """Whether the rule can tell: a false finding is ordinary by its own form, and not assigned to a credential."""
    if rule_label(value, before, assigned):
        return True
    named = assigned and any(_CREDENTIAL.search(w) for w in _WORDS.findall(before)[-3:])
    return not named and _ORDINARY.fullmatch(value) is not None


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH) -> tuple:
    """(feature, cut, left, right), or the share of true labels."""
    share = float(y.mean())
    if depth == 0 or len(y) < 2 * LEAF or share in (0.0, 1.0):
        return (share,)
    best = (np.inf, -1, 0.0)
    for f in rng.choice(x.shape[1], int(math.ceil(math.sqrt(x.shape[1]))), replace=False):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 12))):
            left = x[:, f] <= cut
            n = int(left.sum())
            if LEAF <= n <= len(y) - LEAF:
                a, b = y[left].mean(), y[~left].mean()
                impurity = n * a * (1 - a) + (len(y) - n) * b * (1 - b)
                best = min(best, (impurity, int(f), float(cut)))
    if best[1] < 0:
        return (share,)
    left = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[left], y[left], rng, depth - 1), grow(x[~left], y[~left], rng, depth - 1)


def answer(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    left = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[left], out[~left] = answer(tree[2], x[left]), answer(tree[3], x[~left])
    return out


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of every text with the number of texts of the block they stand in, so that little is left to shuffle."""
    for block in blocks(batches):
        counts: Counter[str] = Counter()
        for text in block.column("text").to_pylist():
            counts.update({w for w in _LETTERS.findall(text.lower()) if len(w) <= LONGEST} if text else ())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def learn_language(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[Language, DataFrame | None]:
    """Transitions and dictionary of all texts; a dictionary that fits no broadcast is returned as a table (word)."""
    counts = docs.select("text").mapInArrow(_text_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.filter("n > 1"), "secret-words")
    code = lambda c: F.when(c == "", 26).otherwise(F.ascii(c) - 97)
    places = counts.select("n", "word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    letter = lambda at: F.when((at < 1) | (at > F.length("word")), "").otherwise(F.substr("word", at, F.lit(1)))
    pairs = places.select("n", code(letter(F.col("i"))).alias("a"), code(letter(F.col("i") + 1)).alias("b"))
    pairs = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    table = {(r.a, r.b): r.n for r in pairs.collect()}  # 27 x 27 rows at most
    if fits(counts, 60, broadcast_bytes):
        return Language({r.word for r in counts.select("word").collect()}, table), None  # checked: fits a broadcast
    return Language(set(), table), counts.select("word")


_CANDIDATES = "doc_id bigint, row_hash bigint, start bigint, length bigint, sha256 string, rule boolean, features array<double>"


def candidates(docs: DataFrame, language: Language, words: DataFrame | None = None) -> DataFrame:
    """``words``: the dictionary as a table, where ``language`` holds none."""
    shared = docs.sparkSession.sparkContext.broadcast(language)
    names = [c.split()[0] for c in _CANDIDATES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.float64())]
    keep = words is not None  # the value stays until its own words are joined

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = []
            for doc_id, tie, text, path in zip(*(block.column(c).to_pylist() for c in ("doc_id", "row_hash", "text", "source"))):
                for start, value, before, after, assigned in find(text):
                    digest = hashlib.sha256(value.encode()).hexdigest()
                    features = describe(value, before, after, assigned, path, shared.value)
                    own = (value,) if keep else ()
                    rule = rule_label(value, before, assigned) if rule_judges(value, before, assigned) else None
                    rows.append((doc_id, tie, start, len(value), digest, rule, features, *own))
            columns = list(zip(*rows)) or [()] * (len(names) + keep)
            own_types = [*types, pa.string()] if keep else types
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, own_types)], names=[*names, "value"][: len(own_types)])

    # Texts without a digit or an assignment have no candidate; they are left out before Python sees them.
    rows = docs.filter(F.col("text").rlike("[0-9=:]"))
    rows = rows.select(F.col("doc_id").cast("bigint"), row_hash().alias("row_hash"), "text", F.col("source").cast("string"))
    if not keep:
        return rows.mapInArrow(run, _CANDIDATES)
    found = written(rows.mapInArrow(run, f"{_CANDIDATES}, value string"), "secret-values")
    return _with_own_words(found, words).mapInArrow(_covered(names, types), _CANDIDATES)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "value"):
        pairs = ((d, part) for d, value in zip(*(block.column(c).to_pylist() for c in ("sha256", "value"))) for part in substrings(value))
        while rows := list(islice(pairs, 1 << 16)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["sha256", "word"])


def _with_own_words(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the dictionary words among the substrings of each value (_words)."""
    values = found.select("sha256", "value").distinct()
    own = values.mapInArrow(_parts, "sha256 string, word string").join(words, "word")
    return found.join(own.groupBy("sha256").agg(F.collect_set("word").alias("_words")), "sha256", "left")


def _covered(names: list[str], types: list[pa.DataType]):
    place = FEATURES.index("coverage")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language = Language(set(), {})
        for batch in batches:
            rows = batch.select([*names, "value", "_words"]).to_pylist()
            for r in rows:
                r["features"][place] = language.coverage(r["value"], set(r["_words"] or ()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names)

    return run


def fit_forest(found: DataFrame, labelled: DataFrame, rows_per_class: int, trees: int) -> list[tuple]:
    """``labelled``: features and label of candidates; each tree learns from its own draw of the bounded sample."""
    sample = bounded_sample(labelled, "label", rows_per_class).select("features", "label")
    rows = sample.collect()  # 2 * rows_per_class rows at most
    if not rows:
        return [(0.0,)]
    x, y = np.array([r.features for r in rows]), np.array([float(r.label) for r in rows])
    data = found.sparkSession.sparkContext.broadcast((x, y))

    def one(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for seed in part["id"].tolist():
                rng = np.random.default_rng(seed)
                own = rng.integers(0, len(data.value[1]), len(data.value[1]))
                yield pd.DataFrame({"id": [seed], "tree": [pickle.dumps(grow(data.value[0][own], data.value[1][own], rng))]})

    grown = found.sparkSession.range(trees).repartition(trees, "id").mapInPandas(one, "id bigint, tree binary").collect()
    return [pickle.loads(r.tree) for r in sorted(grown, key=lambda r: r.id)]


def scan_secrets(
    docs: DataFrame, findings: DataFrame | None = None, rows_per_class: int = ROWS_PER_CLASS, trees: int = TREES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per candidate: doc_id, start, length (characters), sha256 of the value, score and is_secret."""
    language, words = learn_language(docs, broadcast_bytes)
    found = written(candidates(docs, language, words), "secret-candidates")
    if findings is None:
        labelled = found.filter(~held_out() & F.col("rule").isNotNull()).withColumn("label", F.col("rule"))
    else:
        marks = findings.groupBy("doc_id", "start").agg(F.max(F.col("label").cast("boolean")).alias("label"))
        labelled = found.join(marks.filter("label IS NOT NULL"), ["doc_id", "start"])
    forest = docs.sparkSession.sparkContext.broadcast(fit_forest(found, labelled, rows_per_class, trees))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), float).reshape(batch.num_rows, len(FEATURES))
            scores = np.mean([answer(tree, x) for tree in forest.value], axis=0)
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "sha256")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(scores), pa.array(scores >= 0.5)], names=["doc_id", "start", "length", "sha256", "score", "is_secret"]
            )

    return found.mapInArrow(score, "doc_id bigint, start bigint, length bigint, sha256 string, score double, is_secret boolean")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))
