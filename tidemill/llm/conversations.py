"""Repair of conversation structure by a weighted generalised LR parse of roles.

A conversation should read: perhaps a system turn, then pairs of user and assistant (``GRAMMAR``), or nothing at all. The
parser's tables are made from the grammar. A row of a conversation is a symbol: the initial of its role and its first fault.
Every stack head takes every edit: keep (the row's own role is shifted), rerole (user or assistant is shifted), delete (nothing
is shifted) and, between rows, insert (user or assistant is shifted). Heads with equal tops are merged and keep their least
(cost, audit), the audit being the edits' initials so far; what may follow a top does not depend on the rest of its stack,
so no cheaper repair is lost. The graph-structured stack thus has one node per top. Two audits of equal cost over the same rows
are never each other's beginning (the longer one would cost more), so the least of them stays the least whatever follows.

A conversation is cut into segments of ``SEGMENT`` rows by rank. A segment's summary holds the least (cost, audit) from each top
to each other one; summaries of neighbours are joined ``FAN`` at a time until one is left. So no task needs a whole
conversation for parsing; the rows' texts stay out of it (their digests tell duplicates). ``repaired`` and ``digests``
then stream the rows, sorted inside their partition, past their conversation's audit without holding any conversation; a
digest is one chain of SHA-256, so that last pass alone is sequential in a conversation.

Defined results: a null role or text reads as one blank; rows of one turn stand in order of role, then of the text's
SHA-256; null turns come first and are ignored for gaps; a null conv_id is a conversation like any other; a role whose initial
is not s, u or a can only be deleted or reroled; equal rows that repeat are duplicates; a conversation without rows has zeros
and an empty audit; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import BLANKS, arrow, importable, side, written
from tidemill.llm.ranks import ranked

GRAMMAR = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "ua"), ("T", "Tua"))
ROLES = {"u": "user", "a": "assistant"}
RIGHT_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
SEGMENT = 2048
FAN = 16

_INITIALS = ("s", "u", "a", "-")
_FAULTS = ("fine", "blank", "duplicate", "truncated")

Head = tuple[int, str]
Ways = list[tuple[int, int, int, str]]


# ---- parse tables


def _closed(items: set[tuple[int, int]]) -> frozenset:
    """Items (production, dot) with those that may begin where a dot stands."""
    items, grown = set(items), True
    while grown:
        wanted = {GRAMMAR[p][1][d] for p, d in items if d < len(GRAMMAR[p][1])}
        more = {(k, 0) for k, (left, _) in enumerate(GRAMMAR) if left in wanted} - items
        items |= more
        grown = bool(more)
    return frozenset(items)


def _goto(state: frozenset, symbol: str) -> frozenset | None:
    moved = {(p, d + 1) for p, d in state if GRAMMAR[p][1][d : d + 1] == symbol}
    return _closed(moved) if moved else None


def _shifted(stack: tuple, symbol: str) -> tuple | None:
    """The stack after a shift and the reductions that leave no choice."""
    state = _goto(stack[-1], symbol)
    if state is None:
        return None
    stack = (*stack, state)
    while len(stack[-1]) == 1:
        ((p, d),) = stack[-1]
        left, right = GRAMMAR[p]
        if d < len(right) or left == "C":
            break
        stack = stack[: len(stack) - d]
        stack = (*stack, _goto(stack[-1], left))
    return stack


def _tables() -> tuple[list[dict[str, int]], set[int]]:
    """For every stack top the tops that shifts lead to, and the tops that accept."""
    start = (_closed({(k, 0) for k, (left, _) in enumerate(GRAMMAR) if left == "C"}),)
    stacks, numbers, moves = [start], {start[0]: 0}, []
    for stack in stacks:
        moves.append({})
        for symbol in "sua":
            after = _shifted(stack, symbol)
            if after is not None:
                if after[-1] not in numbers:
                    numbers[after[-1]] = len(stacks)
                    stacks.append(after)
                moves[-1][symbol] = numbers[after[-1]]
    accepting = {numbers[s[-1]] for s in stacks if any(GRAMMAR[p][0] == "C" and d == len(GRAMMAR[p][1]) for p, d in s[-1])}
    return moves, accepting


MOVES, ACCEPTING = _tables()


# ---- parse


def _put(heads: dict[int, Head], top: int, head: Head) -> bool:
    if top in heads and heads[top] <= head:
        return False
    heads[top] = head
    return True


def _insert(heads: dict[int, Head]) -> dict[int, Head]:
    open_tops = list(heads)
    while open_tops:
        top = open_tops.pop()
        cost, audit = heads[top]
        for symbol in ROLES:
            after = MOVES[top].get(symbol)
            if after is not None and _put(heads, after, (cost + INSERT, audit + "I")):
                open_tops.append(after)
    return heads


def parse(symbols: str, top: int = 0) -> dict[int, Head]:
    """Least (cost, audit) at every top after the rows ``symbols`` (see ``symbol``), from the stack head ``top``."""
    heads = _insert({top: (0, "")})
    for symbol in symbols:
        role, fault = divmod(ord(symbol) - 65, len(_FAULTS))
        initial, fault = _INITIALS[role], _FAULTS[fault]
        after: dict[int, Head] = {}
        for top, (cost, audit) in heads.items():
            _put(after, top, (cost + DELETE, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            stays = cost + (CUT if fault == "truncated" else 0)
            if initial in MOVES[top]:
                _put(after, MOVES[top][initial], (stays, audit + "K"))
            for other in ROLES:
                if other in MOVES[top]:
                    _put(after, MOVES[top][other], (stays + REROLE, audit + "R"))
        heads = _insert(after)
    return heads


def summary(symbols: str, alone: bool) -> dict:
    """Counts, end symbols and ways (from top, to top, cost, audit) of a segment; ``alone``: only from the empty stack."""
    roles = [_INITIALS[(ord(s) - 65) // len(_FAULTS)] for s in symbols]
    counts = [sum((ord(s) - 65) % len(_FAULTS) == k for s in symbols) for k in range(len(_FAULTS))]
    ways = [(a, b, *head) for a in range(1 if alone else len(MOVES)) for b, head in parse(symbols, a).items()]
    return {
        **dict(zip(_FAULTS[1:], counts[1:])),
        "illegal": sum(a + b not in RIGHT_PAIRS for a, b in zip(roles, roles[1:])),
        "first": roles[0],
        "last": roles[-1],
        "ways": ways,
    }


_short = lru_cache(1 << 16)(summary)


def joined(parts: list[dict]) -> dict:
    """Summary of neighbouring segments from theirs."""
    whole = dict(parts[0])
    for part in parts[1:]:
        for name in (*_FAULTS[1:], "illegal"):
            whole[name] += part[name]
        whole["illegal"] += whole["last"] + part["first"] not in RIGHT_PAIRS
        whole["last"] = part["last"]
        onward: dict[int, Ways] = {}
        for a, b, cost, audit in part["ways"]:
            onward.setdefault(a, []).append((b, cost, audit))
        best: dict[tuple[int, int], Head] = {}
        for a, b, cost, audit in whole["ways"]:
            for c, more, tail in onward.get(b, ()):
                _put(best, (a, c), (cost + more, audit + tail))
        whole["ways"] = [(a, c, *head) for (a, c), head in best.items()]
    return whole


_WAY = pa.struct([("source", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_COUNTS = (*_FAULTS[1:], "illegal")
_SUMMARY = pa.struct(
    [*[(n, pa.int64()) for n in _COUNTS], ("first", pa.string()), ("last", pa.string()), ("ways", pa.list_(_WAY))]
)
_SUMMARY_SQL = (
    "struct<"
    + ", ".join(f"{n}: bigint" for n in _COUNTS)
    + ", first: string, last: string, ways: array<struct<source: int, target: int, cost: bigint, audit: string>>>"
)


def _summaries(batch: pa.RecordBatch, found: list[dict]) -> pa.RecordBatch:
    """The batch's columns but the last, with the summaries."""
    shaped = [{**s, "ways": [dict(zip(("source", "target", "cost", "audit"), w)) for w in s["ways"]]} for s in found]
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(shaped, _SUMMARY)], [*batch.schema.names[:-1], "found"])


def _parse_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("symbols").to_pylist(), batch.column("alone").to_pylist())
        yield _summaries(batch, [(_short if len(s) <= 64 else summary)(s, alone) for s, alone in pairs])


def _join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for parts in batch.column("parts").to_pylist():
            parts = [p["found"] for p in parts]
            found.append(joined([{**p, "ways": [tuple(w.values()) for w in p["ways"]]} for p in parts]))
        yield _summaries(batch, found)


# ---- rows


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with the test damage: by checksum of ``conv_id:turn`` a row in twenty is dropped, emptied,
    stripped of sentence ends, repeated, or given to the user."""
    key = F.concat_ws(":", _read("conv_id"), _read("turn"))
    kind = (F.crc32(key.cast("binary")) % 20).alias("_kind")
    known = rows.select("conv_id", "turn", _read("role"), _read("text"), kind).filter("_kind != 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    hurt = known.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times))
    return hurt.select("conv_id", "turn", "role", "text")


def _read(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _symbols(rows: DataFrame) -> DataFrame:
    """conv_id, turn, _rank, _size and the symbol of every row: a letter for the initial of its role and its first fault."""
    body = F.btrim(F.col("text"), F.lit("".join(BLANKS)))
    narrow = rows.select(
        "conv_id",
        "turn",
        _read("role"),
        F.sha2(F.coalesce("text", F.lit(" ")).cast("binary"), 256).alias("digest"),
        F.when(F.col("text").isNull() | (body == ""), 1).when(~F.right(body, F.lit(1)).isin(*".!?"), 3).otherwise(0).alias("fault"),
    )
    placed = written(ranked(narrow, "conv_id", ["turn", "role", "digest"]), "turns")
    again = placed.groupBy("conv_id", "role", "digest").agg(F.min("_rank").alias("_seen"), F.count(F.lit(1)).alias("_n"))
    again = written(again.filter("_n > 1").toDF("_conv", "_role", "_digest", "_seen", "_n"), "repeated-turns")
    placed = placed.join(side(again, 160), _same("conv_id", "_conv") & _same("role", "_role") & _same("digest", "_digest"), "left")
    fault = F.when(F.col("fault") == 1, 1).when(F.col("_rank") > F.col("_seen"), 2).otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.char(F.lit(65) + role * len(_FAULTS) + fault)
    return placed.select("conv_id", "turn", "_rank", "_size", symbol.alias("symbol"))


def plan_repairs(rows: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """One row per conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit."""
    symbols = written(_symbols(rows), "symbols")
    number = F.floor(F.col("_rank") / F.lit(segment)).alias("segment")
    listed = F.sort_array(F.collect_list(F.struct("_rank", "symbol")))
    parts = symbols.groupBy("conv_id", number, (F.col("_size") <= segment).alias("alone")).agg(listed.alias("rows"))
    parts = parts.select("conv_id", "segment", "alone", F.array_join("rows.symbol", "").alias("symbols"))
    schema = f"{_of(rows, 'conv_id')}, segment bigint, alone boolean, found {_SUMMARY_SQL}"
    found = written(parts.mapInArrow(_parse_segments, schema), "segments")
    whole = found.filter("alone")
    rest = found.filter("NOT alone")
    while rest.select(F.max("segment")).first()[0]:
        parts = rest.groupBy("conv_id", F.floor(F.col("segment") / F.lit(fan)).alias("segment"), "alone")
        parts = parts.agg(F.sort_array(F.collect_list(F.struct("segment", "found"))).alias("parts"))
        rest = written(parts.mapInArrow(_join_segments, schema), "segments")
    whole = whole.unionByName(rest)
    ends = F.filter("found.ways", lambda w: (w["source"] == 0) & w["target"].isin(*sorted(ACCEPTING)))
    best = F.array_min(F.transform(ends, lambda w: F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"))))
    parsed = whole.select("conv_id", *[f"found.{n}" for n in _COUNTS], best.alias("best"))
    turns = symbols.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id")
    gaps = (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("bigint")
    turns = turns.agg(F.coalesce(gaps, F.lit(0)).alias("gaps")).withColumnRenamed("conv_id", "_conv")
    return parsed.join(turns, _same("conv_id", "_conv")).select("conv_id", "gaps", *_COUNTS, "best.cost", "best.audit")


def _of(df: DataFrame, name: str) -> str:
    return f"{name} {df.schema[name].dataType.simpleString()}"


# ---- repaired conversations


class _Repair:
    """Edits the rows of one conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, ""

    def _next(self) -> str:
        return "a" if self.last == "u" else "u"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.last = self._next()
            yield "I", ROLES[self.last], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role = ROLES[self._next()]
        if edit != "D":
            self.last = role[0]
            yield edit, role, text


def _streamed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Every conversation's audit (kind 0), then its rows in order, in one partition."""
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", _read("role"), _read("text"))
    texts = texts.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    heads = plan.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("text"))
    both = texts.unionByName(heads, allowMissingColumns=True).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return ordered.select("conv_id", "kind", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) of repaired rows; before them (conv_id, "", "", "") for each conversation."""
    now, conv = None, None
    for batch in batches:
        for key, kind, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if kind == 0:
                if now is not None:
                    yield from ((conv, *e) for e in now.inserted())
                now, conv = _Repair(text), key
                yield conv, "", "", ""
            else:
                yield from ((conv, *e) for e in now.row(role, text))
    if now is not None:
        yield from ((conv, *e) for e in now.inserted())


def _batch(rows: list[tuple], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), fields.values())], list(fields))


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), edit, role and text. ``plan`` has a row for every conversation."""
    schema = f"{_of(rows, 'conv_id')}, place bigint, edit string, role string, text string"
    key = arrow(rows.select("conv_id"))[0].type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = {"conv_id": key, "place": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
        place, held, size = 0, [], 0
        for conv, edit, role, text in _conversations(batches):
            if not edit:
                place = 0
                continue
            held.append((conv, place, edit, role, text))
            place, size = place + 1, size + len(text) + 50
            if size > 1 << 20:
                yield _batch(held, fields)
                held, size = [], 0
        if held:
            yield _batch(held, fields)

    return _streamed(rows, plan).mapInArrow(run, schema)


def digests(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired rows, each ``role:text``, joined by line feeds."""
    schema = f"{_of(rows, 'conv_id')}, repaired_sha256 string"
    key = arrow(rows.select("conv_id"))[0].type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = {"conv_id": key, "repaired_sha256": pa.string()}
        done, chain, fresh = [], None, True
        for conv, edit, role, text in _conversations(batches):
            if not edit:
                if chain is not None:
                    done[-1] = (done[-1], chain.hexdigest())
                if len(done) == 10_000:
                    yield _batch(done, fields)
                    done = []
                chain, fresh = hashlib.sha256(), True
                done.append(conv)
                continue
            chain.update(f"{'' if fresh else chr(10)}{role}:{text}".encode())
            fresh = False
        if chain is not None:
            done[-1] = (done[-1], chain.hexdigest())
            yield _batch(done, fields)

    return _streamed(rows, plan).mapInArrow(run, schema)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    original = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    hurt = damage(original)
    found = original.select(F.col("conv_id").alias("_conv")).distinct()
    plan = found.join(plan_repairs(hurt), _same("conv_id", "_conv"), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *_COUNTS, "cost")]
    plan = written(plan.select(F.col("_conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit")), "repairs")
    sums = digests(hurt, plan).withColumnRenamed("conv_id", "_conv")
    return plan.join(sums, _same("conv_id", "_conv")).select(*plan.columns, "repaired_sha256")
