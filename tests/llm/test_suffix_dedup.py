import hashlib
import random
from collections import Counter

import pytest

from tests.llm.fixtures import frame, odd_rows, rows_of, sentence, with_clashes
from tidemill.llm.suffix_dedup import remove_repeats, repeated_starts

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(rows, width=400):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(hash(t[i : i + width]) for t in texts for i in range(len(t) - width + 1))
    out = []
    for row, text in zip(rows, texts):
        gone = bytearray(len(text))
        end = 0
        for i in range(len(text) - width + 1):
            if seen[hash(text[i : i + width])] > 1:
                for j in range(max(i, end), i + width):
                    gone[j] = 1
                end = i + width
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((row[0], len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed):
    rng = random.Random(seed)
    shared = [sentence(rng, 80) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(5, 60)) for _ in range(3)]
        if i % 2:
            passage = rng.choice(shared)
            cut = rng.randrange(0, 200)
            parts.insert(rng.randrange(3), passage[cut : cut + rng.randrange(380, 560)])
        rows.append((i, " ".join(parts)))
    rows += [(100, "ab" * 700), (101, "é" * 900), (102, rows[1][1]), (103, rows[3][1] + "x"), (104, sentence(rng, 300) * 2)]
    return rows


def test_equals_brute_force(spark):
    rows = passages(1)
    for limits in ({}, {"key_covers": 2, "collection_bytes": 5000}):
        assert rows_of(remove_repeats(frame(spark, rows), **limits), *COLUMNS) == brute(rows)


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(remove_repeats(docs), *COLUMNS) == brute(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    found = remove_repeats(with_clashes(frame(spark, rows)), keep_text=True)
    assert rows_of(found, *COLUMNS) == brute(rows)
    assert remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_interval_expansion(seed):
    rng = random.Random(seed)
    width = rng.choice([5, 12, 40])
    letters = b"ab" if seed % 2 else b"abcdefgh"
    pool = [bytes(rng.choice(letters) for _ in range(rng.randrange(width, 4 * width))) for _ in range(6)]
    covers = [b"".join(rng.choice(pool) for _ in range(rng.randrange(1, 3))) for _ in range(rng.randrange(1, 8))]
    counts = Counter(c[i : i + width] for c in covers for i in range(len(c) - width + 1))
    for cover, flags in zip(covers, repeated_starts(covers, width)):
        assert flags.tolist() == [counts[cover[i : i + width]] > 1 for i in range(len(cover) - width + 1)]
