import random
import re

import pytest

from tests.llm.fixtures import frame, odd_rows, rows_of, sentence, with_clashes
from tidemill.llm import components as parts
from tidemill.llm.common import written
from tidemill.llm.ngram_join import ngram_components


def brute(rows):
    """(doc_id, set size, smallest id reachable), every pair compared."""
    sets = []
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), row[1] or ""))
        size = 5 if len(words) >= 5 else len(words)
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(((r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(n, seed):
    rng = random.Random(seed)
    base, line = sentence(rng, 120).split(), sentence(rng, 30)
    rows = []
    for i in range(n):
        words = list(base) if i % 3 else sentence(rng, 60).split()
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(500)}"
        rows.append((i, " ".join(words) + ("\n" + line if i % 2 else "")))
    return rows


@pytest.mark.parametrize("limits", [{}, {"group_rows": 8, "block_rows": 10, "first_queries": 2}])
def test_equals_brute_force(spark, limits):
    rows = near_copies(90, 3) + [(500 + i, t) for i, (_, t) in enumerate(near_copies(12, 3))]
    found = ngram_components(frame(spark, rows), **limits)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute(rows)


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(ngram_components(docs), "doc_id", "n_shingles", "component_id") == brute(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    found = ngram_components(with_clashes(frame(spark, rows)))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute(rows)


def test_empty_table(spark):
    assert ngram_components(frame(spark, [])).count() == 0


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(parts, "written", lambda df, purpose: stored.append(purpose) or written(df, purpose))

    def found(links):
        stored.clear()
        rows = parts.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
        assert len(rows) == len(set(rows))
        return {r.node: r.root for r in rows}

    assert found([(1, 2), (3, 1), (7, 5), (1, 3)]) == {1: 1, 2: 1, 3: 1, 5: 5, 7: 5}
    assert stored == ["links"]
    assert found([]) == {} and stored == ["links"]
    assert set(found([(i, i + 1) for i in range(40)] + [(60, 50), (60, 55)]).items()) == {
        *((i, 0) for i in range(41)), (50, 50), (55, 50), (60, 50)
    }
    assert len(stored) > 1
