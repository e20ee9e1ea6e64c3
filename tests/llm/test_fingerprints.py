import hashlib

import numpy as np

from tests.llm.fixtures import frame, odd_rows, sentence, with_clashes
from tidemill.llm import fingerprints as f


def brute_edits(rows):
    """(doc_id, characters, hash of the edited text) for rows in falling order, the last one followed by the first."""
    out = []
    for row, following in zip(rows, rows[1:] + rows[:1]):
        own, other = row[1] or "", following[1] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + other[:half]
        out.append((row[0], len(own), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    found = f.fingerprints(docs).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(brute_edits(rows))
    prints = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(dict(rows)[r.doc_id], r.fingerprint) == r.fingerprint
    assert np.mean([r.near_edited for r in found]) > np.mean([r.near_next for r in found]) + 0.2


def test_odd_rows(spark):
    rows = [r for r in odd_rows() if r[0] not in (8, None)]
    found = f.fingerprints(with_clashes(frame(spark, rows))).collect()
    want = brute_edits(sorted(rows, key=lambda r: -r[0]))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(want)
    assert f.fingerprints(frame(spark, odd_rows())).count() == len(odd_rows())
    assert f.fingerprints(frame(spark, [])).count() == 0
    one = f.fingerprints(frame(spark, [(3, "only")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_equal_substrings_are_cut_alike():
    import random

    rng = random.Random(4)
    inner = sentence(rng, 400).encode()

    def cuts(text, at, levels):
        symbols, first, place = np.frombuffer(text, np.uint8), np.array([0]), np.arange(len(text))
        for _ in range(levels):
            symbols, first, begins = f.parse(symbols, first)
            place = place[begins]
        inside = (place >= at + 400) & (place < at + len(inner) - 400)
        return set(zip((place[inside] - at).tolist(), symbols[inside].tolist()))

    for levels in (1, 2, 3):
        a = cuts(b"prefix " + inner + b" tail", 7, levels)
        b = cuts(b"zz" * 50 + inner, 100, levels)
        assert len(a) > 20 and len(a & b) >= len(a) - 2


def test_labels_differ_and_phrases_are_short():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 5000).astype(np.uint8)
    keep = np.concatenate([[True], text[1:] != text[:-1]])
    text = text[keep]
    labels = f._labels(text, np.array([0]))
    assert labels.max() < 6 and (labels[1:] != labels[:-1]).all()
    names, _, begins = f.parse(text, np.array([0]))
    assert np.diff(np.concatenate([begins, [len(text)]])).max() <= 12 and len(names) == len(begins)
    wide = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    labels = f._labels(wide, np.array([0]))
    assert labels.max() < 6 and (labels[1:] != labels[:-1]).all()


def test_likeness_does_not_jump_with_length():
    rng = np.random.default_rng(8)
    found = {}
    for a, b in ((197, 199), (199, 200), (199, 201)):
        near = []
        for _ in range(60):
            text = bytes(rng.choice(np.frombuffer(b"abcdefghij klmnop", np.uint8), b))
            two = f._sketch_texts([text[:a], text])
            near.append(f.likeness(two[:1], two[1:])[0])
        found[a, b] = np.mean(near)
    assert max(found.values()) - min(found.values()) < 0.05 and min(found.values()) > 0.8


def test_rows_that_repeat(spark):
    rows = [(5, "the same text")] * 400 + [(6, "another"), (4, "last")]
    found = f.fingerprints(frame(spark, rows), rows_per_part=50).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(brute_edits(sorted(rows, key=lambda r: -r[0])))
