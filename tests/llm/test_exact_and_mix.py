import hashlib
import re

import pytest

from tests.llm.fixtures import frame, odd_rows, rows_of, with_clashes
from tidemill.llm import exact_dedup as e
from tidemill.llm import mixing as m


def brute_exact(rows):
    groups = {}
    for i, row in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")
        groups.setdefault(body, []).append((-len(row[1] or ""), row[0] is None, row[0] or 0, i))
    out = []
    for body, members in groups.items():
        first = min(members)
        keep = rows[first[3]][0]
        for member in members:
            digest = hashlib.sha256(body.encode()).hexdigest()
            out.append((rows[member[3]][0], keep, len(members), member[3] == first[3], digest))
    return sorted(out, key=repr)


def test_exact_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    docs = with_clashes(frame(spark, rows))
    assert rows_of(e.exact_dedup(docs, digests=True), *columns) == brute_exact(rows)
    monkeypatch.setattr(e, "fits", lambda df, row_bytes: False)
    assert rows_of(e.exact_dedup(docs, digests=True), *columns) == brute_exact(rows)
    assert e.exact_dedup(frame(spark, [])).count() == 0


def test_exact_reads_the_whole_of_survivors_only(spark):
    rows = [(1, "a" * 70 + "x"), (2, "a" * 70 + "y"), (3, "b" * 71), (4, "c"), (5, " c"), (6, "d" * 5)]
    found = {r.doc_id: r for r in e.exact_dedup(frame(spark, rows)).collect()}
    assert {k for k, r in found.items() if r.text_sha256} == {1, 2, 4, 5}
    assert [found[k].kept for k in (1, 2, 4, 5)] == [True, True, False, True]


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight; what a source cannot take is shared again, until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        share = sum(weight[s] for s in order if s not in fixed)
        target = {s: left * weight[s] / share for s in order if s not in fixed}
        above = [s for s in target if target[s] > cap * sizes[s]]
        if not above:
            return {**fixed, **target}
        fixed |= {s: float(cap * sizes[s]) for s in above}


@pytest.mark.parametrize("block_rows", [m.BLOCK_ROWS, 40])
def test_mix(spark, sf, block_rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet").drop("n_chars")
    odd = frame(spark, [r[:2] + (None, None) for r in odd_rows()]).drop("n_chars")
    docs = docs.unionByName(odd)
    rows = m.mix(with_clashes(docs), block_rows=block_rows).collect()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    assert len(rows) == docs.count()
    words = {(r.doc_id, r.text): len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    assert sorted(r.size for r in rows) == sorted(words[(r.doc_id, r.text)] for r in docs.collect())
    goal = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
    for source, target in goal.items():
        if source is None:
            continue  # two texts of 30,000 words and little else: no whole documents come near
        assert abs(taken[source] - target) <= max(0.05 * target, 30)
    again = m.mix(docs, block_rows=block_rows)
    assert rows_of(again, "doc_id", "row_hash", "copies") == sorted(((r.doc_id, r.row_hash, r.copies) for r in rows), key=repr)


def test_mix_empty(spark):
    assert m.mix(frame(spark, [])).count() == 0


def test_flight_keeps_totals():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(30):
        size = np.sort(rng.integers(1, 900, 200))[::-1]
        p = np.full(200, rng.uniform(0.05, 0.95))
        x = m.flight(p, size, rng)
        assert ((x > 0) & (x < 1)).sum() <= 2
        assert x.sum() == pytest.approx(p.sum()) and (x * size).sum() == pytest.approx((p * size).sum())
