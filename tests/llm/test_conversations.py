import hashlib
import random
import re
import zlib
from functools import lru_cache

from tests.llm.fixtures import rows_of, with_clashes
from tidemill.llm import conversations as cv

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


@lru_cache(None)
def cheapest(rows):
    """Least (cost, audit, output) by trying every edit; rows: (initial, must go, cut, role, text)."""
    best = [(4 * len(rows) + 1, "", ())]

    def go(i, cost, audit, out):
        if cost > best[0][0] or not re.fullmatch("s?(ua)*u?|", "".join(o[0] for o in out)):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(o[0] for o in out)):
            best[0] = min(best[0], (cost, audit, out))
        for role in ("user", "assistant"):
            go(i, cost + 3, audit + "I", out + ((role[0], role, ""),))
        if i < len(rows):
            initial, gone, cut, role, text = rows[i]
            go(i + 1, cost + 4, audit + "D", out)
            if not gone:
                go(i + 1, cost + 3 * cut, audit + "K", out + ((initial, role, text),))
                for other in ("user", "assistant"):
                    go(i + 1, cost + 3 * cut + 3, audit + "R", out + ((other[0], other, text),))

    go(0, 0, "", ())
    return best[0]


def plain(rows):
    groups = {r[0]: [] for r in rows}
    for r in damaged(rows):
        groups[r[0]].append(r)
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, codes, counts = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            body = text.strip(BLANK)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            codes.append((role[:1] if role[:1] in ("s", "u", "a") else "-", fault in (0, 1), fault == 2, role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        cost, audit, texts = cheapest(tuple(codes))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in texts).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def run(spark, rows, path, clashes=False):
    df = spark.createDataFrame(rows, SCHEMA)
    (with_clashes(df) if clashes else df).write.parquet(f"{path}/conversations.parquet")
    return rows_of(cv.op12_conversation_repair(spark, str(path)), *COLUMNS)


def some_rows(seed, n, longest=5):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            rows.append((conv, turn + rng.randint(0, 1) * 3, role, rng.choice(["Yes.", "No", "Why?", " ", f"T{turn}!", f"x{turn}"])))
    return rows


def test_against_every_edit(spark, tmp_path):
    rows = some_rows(4, 150)
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (900, None, "user", "A."), (900, None, "assistant", "B.")]
    rows += [(901, 5, None, "No role."), (902, 0, "", "Empty role."), (903, 2, "User", "Big."), (904, 1, "user", None)]
    rows += [(905, 3, "user", "x" * 300_000 + "."), (905, 4, "assistant", "y" * 300_000)]
    assert run(spark, rows, tmp_path / "a", True) == plain(rows)
    assert run(spark, [], tmp_path / "b") == []


def test_long_and_repeated_conversations(spark):
    rng = random.Random(7)
    symbols = "".join(chr(65 + rng.choice([0, 4, 4, 8, 8, 8, 12]) + rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(400))
    whole = cv.summary(symbols, False)
    for size in (1, 7, 64, 399):
        parts = [cv.summary(symbols[a : a + size], False) for a in range(0, len(symbols), size)]
        found = cv.joined(parts)
        assert {(a, b): (c, t) for a, b, c, t in found["ways"]} == {(a, b): (c, t) for a, b, c, t in whole["ways"]}
        assert {k: v for k, v in found.items() if k != "ways"} == {k: v for k, v in whole.items() if k != "ways"}
    rows = [(1, t, "user" if t % 2 else "assistant", f"line {t % 90}.") for t in range(700)] + [(2, 0, "user", "Same.")] * 500
    df = spark.createDataFrame(rows, SCHEMA)
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    assert rows_of(cv.plan_repairs(df, segment=11, fan=3), *names) == rows_of(cv.plan_repairs(df), *names)


def test_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(cv.op12_conversation_repair(spark, sf), *COLUMNS) == plain(rows)
    hurt = cv.damage(spark.createDataFrame(rows, SCHEMA))
    plan = cv.plan_repairs(hurt)
    texts = {}
    for r in sorted(cv.repaired(hurt, plan).collect(), key=lambda r: (r.conv_id, r.place)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    wanted = {r[0]: r[8] for r in plain(rows)}
    for r in plan.collect():
        joined = "\n".join(texts.get(r.conv_id, []))
        assert hashlib.sha256(joined.encode()).hexdigest() == wanted[r.conv_id]
