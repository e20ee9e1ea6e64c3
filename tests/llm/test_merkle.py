import hashlib
import random
import zlib

import duckdb

from tests.llm.fixtures import frame, odd_rows, rows_of, with_clashes
from tidemill.llm import merkle


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: tuple, text) -> str:
    doc_id, _, lang, source, n = row
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)]
    return sha("".join(fields))


def tree(nodes: list[str]) -> tuple[str, list[list[list[str]]]]:
    """Root, and for each leaf the (left, right) digests on its way up."""
    ways, level, members = [[] for _ in nodes], nodes, [[i] for i in range(len(nodes))]
    while len(level) > 1:
        upper, held = [], []
        for a in range(0, len(level), 16):
            run = level[a : a + 16]
            for k in range(len(run)):
                for i in members[a + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(sha("".join(run)))
            held.append([i for m in members[a : a + 16] for i in m])
        level, members = upper, held
    return level[0], ways


def lower_ascii(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows: list[tuple]) -> list[tuple]:
    full = [(r + (None, None))[:4] + (len(r[1]) if r[1] is not None else None,) for r in rows]
    groups: dict = {}
    for r in full:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found, subroots = [], []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        subroot, ways = tree([leaf(r, r[1]) for r in own])
        subroots.append(subroot)
        found.append((own, ways))
    root, tops = tree(subroots)
    out = []
    for k, (own, ways) in enumerate(found):
        for r, way in zip(own, ways):
            now = leaf(r, lower_ascii(r[1])) if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 0 else leaf(r, r[1])
            for left, right in way + tops[k]:
                now = sha(left + now + right)
            proof = sha("".join(a + b for a, b in way + tops[k]))
            out.append((r[0], leaf(r, r[1]), subroots[k], root, proof, now, now == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def run(spark, rows, tmp_path, clashes=False):
    df = frame(spark, rows)
    path = str(tmp_path / f"d{len(rows)}{clashes}")
    (with_clashes(df) if clashes else df).write.parquet(f"{path}/documents.parquet")
    return rows_of(merkle.op11_merkle_manifest(spark, path), *COLUMNS)


def test_odd_rows(spark, tmp_path):
    assert run(spark, odd_rows(), tmp_path, True) == plain(odd_rows())
    assert run(spark, [], tmp_path) == []
    assert run(spark, [(5, "One", "en", "a")], tmp_path) == plain([(5, "One", "en", "a")])


def test_more_than_one_block_and_repeated_rows(spark, tmp_path):
    rng = random.Random(2)
    sizes = {"a": 600, "b": 257, "c": 256, "d": 17, "e": 16, None: 2, "é": 1, "Z": 1}
    rows = [(rng.randrange(5000), f"Text {rng.randrange(400)} x" * rng.randrange(3), "en", s) for s, n in sizes.items() for _ in range(n)]
    rows += [(77, "Same", "en", "a")] * 300 + [(i, "Lone", None, f"s{i}") for i in range(20)]
    assert run(spark, rows, tmp_path) == plain(rows)


def test_proofs_are_whole_and_sql_agrees(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    found = rows_of(merkle.op11_merkle_manifest(spark, sf), *COLUMNS)
    assert {r[6] for r in found} == {True, False} and len(found) == len(rows)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        assert sorted(db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({merkle.ORACLE_SQL})").fetchall(), key=repr) == found
    for r in merkle.manifest(docs).filter("doc_id % 50 = 0").collect():
        now = r.leaf
        for p in r.proof:
            now = sha(p.left + now + p.right)
        assert now == r.root
