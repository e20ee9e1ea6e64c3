import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import frame, odd_rows, with_clashes
from tidemill.llm import packing as p


def check(rows, pieces, width=p.WIDTH):
    """Every id in exactly one piece, sequences gapless and not too long; returns (padding, tokens)."""
    tokenizer = Tokenizer.from_file(p.vocabulary_path())
    ids = {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [p.SEPARATOR] for r in rows}
    seen, sequences = {}, {}
    for r in pieces:
        whole = ids[r.doc_id]
        part = np.array(whole[r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(whole)
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    repeats = {key: [r[0] for r in rows].count(key) for key in ids}
    for key, parts in seen.items():
        assert sum(n for _, n in parts) == repeats[key] * len(ids[key])
        if repeats[key] == 1:
            at = 0
            for start, n in sorted(parts):
                assert start == at
                at += n
    assert set(seen) == set(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= width
        padding += 0 if at & (at - 1) == 0 else width - at
    return padding, sum(len(ids[k]) * n for k, n in repeats.items())


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    padding, tokens = check(rows, p.pack(docs).collect())
    assert padding < 0.02 * tokens


def test_odd_rows(spark):
    rows = [r for r in odd_rows() if r[0] is not None or r[1]]
    check(rows, p.pack(with_clashes(frame(spark, rows))).collect())
    assert p.pack(frame(spark, [])).count() == 0


def test_blocks_carry_over(spark, sf, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    monkeypatch.setattr(p, "BLOCK_TOKENS", 20_000)
    packer, out = p.Packer(p.WordTokens(p.vocabulary_path()), p.WIDTH, 0), []
    for key, text in rows:
        out += packer.add([key], [(text or "").encode()])
    out += packer.flush(last=True)

    class Piece:
        def __init__(self, row):
            self.doc_id, self.start, self.length, self.ids_crc32, self.doc_tokens, self.sequence_id, self.offset = row

    check(rows, [Piece(r) for r in out])


def test_unusual_words():
    texts = ["a\x1cb c d  e", "<|endoftext|>x <|EndOfText|>", "don't 'S x's l'été é İI 12a3b !?x", "﻿́ ok", "日本語。 ...",
             "İ" * 3 + " İx ſ K Å"]
    ids, offsets = p.WordTokens(p.vocabulary_path()).encode([t.encode() for t in texts])
    tokenizer = Tokenizer.from_file(p.vocabulary_path())
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def cheapest(at, cost, width):
    best = [0.0] + [np.inf] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            n = at[j] - at[i]
            if n <= width:
                pad = 0 if n & (n - 1) == 0 and n >= 1 << p.LEAST_POWER else width - n
                best[j] = min(best[j], best[i] + pad + cost[j] + p.SEQUENCE_PENALTY)
    return best[-1]


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_the_cheapest(seed):
    rng = random.Random(seed)
    places = np.cumsum([rng.randrange(1, 90) for _ in range(150)])
    stops = places[[rng.random() < 0.6 for _ in places]]
    at, cost = p.candidates(places[::7], stops, int(places[-1]), 256, True)
    path = p.cut(at, cost, 256)
    price = dict(zip(at.tolist(), cost.tolist()))
    total = 0
    for a, b in zip(path, path[1:]):
        n = b - a
        total += (0 if n & (n - 1) == 0 and n >= 1 << p.LEAST_POWER else 256 - n) + price[b] + p.SEQUENCE_PENALTY
    assert path[0] == 0 and total == pytest.approx(cheapest(at.tolist(), cost.tolist(), 256))


def test_ageing_table_gives_the_same_ids():
    path = p.vocabulary_path()
    rng = np.random.default_rng(5)
    words = ["w%x" % i for i in range(400)] + ["the", "of", "Don't", "naïve", "x.", "北京"]
    blocks = [[" ".join(rng.choice(words, 60)).encode(), b""] for _ in range(20)]
    plain, ageing = p.WordTokens(path), p.WordTokens(path, known_words=40)
    for block in blocks:
        (ids, offsets), (same, bounds) = plain.encode(block), ageing.encode(block)
        assert ids.tolist() == same.tolist() and offsets.tolist() == bounds.tolist()
    assert len(ageing.index) < len(plain.index)
