import numpy as np

from tests.llm.fixtures import frame, odd_rows, with_clashes
from tests.llm.test_models import out_of_training
from tidemill.llm import quality as q


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = {r.doc_id: r for r in q.op13_quality(spark, sf).collect()}
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == out_of_training(k) and 0 <= r.score <= 1 for k, r in found.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in found.values())
    held = [(found[k].score, y) for k, y in truth.items() if found[k].held_out]
    good, bad = ([s for s, y in held if y == label] for label in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_odd_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ids = [r.doc_id for r in labels.collect() if not out_of_training(r.doc_id)]
    assert ids
    odd = with_clashes(frame(spark, odd_rows()))
    rows = q.quality(odd.drop("score"), labels.limit(0)).collect()
    assert [r.score for r in rows] == [0.0] * len(odd_rows())
    one = spark.createDataFrame([(7, 1), (7, 0), (8, None)], "doc_id bigint, quality int")
    assert {r.score for r in q.quality(odd.drop("score"), one).collect()} == {1.0}
    two = spark.createDataFrame([(7, 1), (5, 0), (6, 0), (8, 1), (11, 1), (10, 1)], "doc_id bigint, quality int")
    rows = q.quality(odd.drop("score"), two).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if r.doc_id in (1, 2)}
    assert len(blank) == 1
    assert q.quality(docs.limit(0), labels).count() == 0


def plain_scores(model, counts):
    """Votes by plain loops."""
    def vector(row):
        x = [np.log1p(c) * r for c, r in zip(row, model.rarity)]
        for a, b in ((0, q.WORDS), (q.WORDS, q.TERMS)):
            size = max(np.sqrt(sum(v * v for v in x[a:b])), 1e-12)
            x[a:b] = [v / size for v in x[a:b]]
        y = np.array(x) @ model.space
        return y / max(np.sqrt((y * y).sum()), 1e-12)

    out = []
    for row in counts:
        near = [float(vector(row) @ p) for p in model.points]
        last = sorted(near, reverse=True)[: q.NEIGHBOURS][-1]
        votes = [(max(s, 0) ** q.SHARPNESS * w, y) for s, w, y in zip(near, model.weights, model.labels) if s >= last - 1e-6]
        total = sum(v for v, _ in votes)
        out.append(sum(v * y for v, y in votes) / total if total else model.share)
    return out


def test_votes_and_terms_equal_plain_loops():
    rng = np.random.default_rng(3)
    words = ["stone", "River", "ÉTÉ", "99", "###", "a|b", "你好", "x!!"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 30))) + ("\nsame\nsame" if i % 3 == 0 else "") for i in range(40)] + ["", None]
    counts = q.term_counts(texts)
    labels = np.array([i % 2 for i in range(30)])
    model = q.learn_model(q.rarity_of((counts > 0).sum(axis=0), len(texts)), counts[:30], labels, 0.8)
    assert np.allclose(model.scores(counts)[28:], plain_scores(model, counts[28:]), atol=1e-3)
    for text, row in zip(texts, counts):
        own = (text or "").split()
        repeats = sum(a.lower() == b.lower() for a, b in zip(own, own[1:]))
        lines = (text or "").split("\n")
        assert row[0] == repeats and row[1] == sum(a == b != "" for a, b in zip(lines, lines[1:]))
        assert row[2 : q.WORDS].sum() == len(own)
    exact = np.linalg.svd(q.weighted(counts, model.rarity)[:30], full_matrices=False)[2][: model.space.shape[1]]
    assert np.abs(np.linalg.svd(exact @ model.space)[1] - 1).max() < 0.2


def test_long_text_is_read_whole():
    text = "Plain words stand here. " * 60_000
    far = text + "### ### ###"
    assert (q.term_counts([far]) - q.term_counts([text])).sum() > 10
    together = q.term_counts(["a b", far, "c"])
    assert np.array_equal(together[1], q.term_counts([far])[0]) and np.array_equal(together[2], q.term_counts(["c"])[0])
