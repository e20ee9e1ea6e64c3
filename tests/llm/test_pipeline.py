import duckdb

import corpus_pipeline
from tests.llm.fixtures import frame, odd_rows
from tests.llm.test_exact_and_mix import brute_exact
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing import check
from tidemill.llm import catalogue


def test_check_statement(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    for key, sql in catalogue.ORACLES.items():
        df = catalogue.QUERIES[key](spark, sf)
        columns = sorted(df.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(want)


def test_names():
    names = list(catalogue.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in names if n != "pipeline"] == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "mix", "pack"]


def test_stages_against_brute_force(spark, sf):
    given = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [(1000 + r[0], r[1], None, "src1") for r in odd_rows() if r[0] not in (5, 6, None)]
    docs = given.unionByName(frame(spark, [*odd, (None, "a text of its own without an id", "en", "src2")]))
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language"](spark, docs, sf)
    rows = [tuple(r) for r in known.collect()]
    letterless = [r for r in docs.collect() if not any(c.isalpha() for c in r.text or "")]
    assert known.columns == columns and len(rows) == docs.count() - len(letterless)

    known = spark.createDataFrame(rows, docs.schema)
    exact = stages["exact"](spark, known, sf)
    kept = [tuple(r) for r in exact.collect()]
    want = sorted([r[0] for r in brute_exact(rows) if r[3]], key=repr)
    assert exact.columns == columns and sorted([r[0] for r in kept], key=repr) == want

    near = stages["near"](spark, spark.createDataFrame(kept, docs.schema), sf)
    left = [tuple(r) for r in near.collect()]
    want = sorted([i for i, _, least in brute(kept) if i == least], key=repr)
    assert near.columns == columns and sorted([r[0] for r in left], key=repr) == want

    mixed = stages["mix"](spark, spark.createDataFrame(left, docs.schema), sf)
    taken = [tuple(r) for r in mixed.collect()]
    assert mixed.columns == columns and set(taken) <= set(left) and 0 < len(taken)
    assert max(taken.count(r) for r in set(taken)) <= 3

    pieces = stages["pack"](spark, spark.createDataFrame(taken, docs.schema), sf).collect()
    check([(r[0], r[1]) for r in taken], pieces)


def test_empty_table(spark, sf):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0, name
