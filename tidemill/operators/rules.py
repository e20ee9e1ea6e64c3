"""Expectation suites: typed rules compiled to one aggregation per table.

Row rules of a suite share a single pass that reduces to one row on the map side. Rules about distinct values
need the values grouped: one more pass counts the values of all their columns together and reads no other column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exprs import Day, on_day, ratio
from tidemill.functions.keyed import join_dimension


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | None = None
    other: str | None = None
    low: float | None = None
    high: float | None = None
    strict_low: bool = False
    values: tuple[str, ...] = ()
    regex: str | None = None
    mostly: float = 1.0
    priority: str = "P2"
    category: str = "unknown"


def expect_not_null(column: str, **meta) -> Rule:
    return Rule("not_null", column, **meta)


def expect_match_regex(column: str, regex: str, **meta) -> Rule:
    return Rule("match_regex", column, regex=regex, **meta)


def expect_in_set(column: str, values: Sequence[str], **meta) -> Rule:
    return Rule("in_set", column, values=tuple(values), **meta)


def expect_between(column: str, low: float | None = None, high: float | None = None, strict_low: bool = False, **meta) -> Rule:
    return Rule("between", column, low=low, high=high, strict_low=strict_low, **meta)


def expect_pair_a_ge_b(column: str, other: str, **meta) -> Rule:
    return Rule("pair_a_ge_b", column, other=other, **meta)


def expect_unique(column: str, **meta) -> Rule:
    return Rule("unique", column, **meta)


def expect_row_count(low: float, high: float, **meta) -> Rule:
    return Rule("row_count", None, low=low, high=high, **meta)


def expect_unique_proportion(column: str, low: float, high: float, **meta) -> Rule:
    return Rule("unique_proportion", column, low=low, high=high, **meta)


def expect_mean(column: str, low: float, high: float, **meta) -> Rule:
    return Rule("mean", column, low=low, high=high, **meta)


_DISTINCT_KINDS = ("unique", "unique_proportion")


def events_suite(devices: Sequence[str] = ("ios", "android", "web")) -> list[Rule]:
    """Rules for payment-app events. Thresholds, pattern, priorities, categories."""
    return [
        expect_not_null("event_id", priority="P0", category="completeness"),
        expect_not_null("user_id", priority="P0", category="completeness"),
        expect_not_null("event_timestamp", priority="P0", category="completeness"),
        expect_match_regex("event_name", r"^[a-z]+\.[a-z]+\.[a-z_]+$", priority="P0", category="consistency"),
        expect_in_set("device_type", devices, priority="P1", category="validity"),
        expect_between("properties.amount", 0, 100000000, mostly=0.99, priority="P0", category="accuracy"),
        expect_pair_a_ge_b("event_timestamp", "user_created_at", mostly=0.99, priority="P1", category="consistency"),
        expect_unique("event_id", priority="P0", category="uniqueness"),
        expect_row_count(10000, 50000000, priority="P1", category="volume"),
        expect_unique_proportion("session_id", 0.01, 1.0, priority="P2", category="distribution"),
    ]


def transactions_suite(
    methods: Sequence[str] = ("card", "app_balance", "bank_transfer", "virtual_account"),
    status_column: str = "transaction_status",
) -> list[Rule]:
    """Rules for transactions. Thresholds, pattern, status set, priorities, categories."""
    statuses = ("COMPLETED", "REFUNDED", "FAILED", "PENDING", "CANCELLED")
    return [
        expect_not_null("transaction_id", priority="P0", category="completeness"),
        expect_unique("transaction_id", priority="P0", category="uniqueness"),
        expect_between("amount", 0, None, strict_low=True, priority="P0", category="accuracy"),
        expect_in_set(status_column, statuses, priority="P0", category="validity"),
        expect_in_set("payment_method", methods, priority="P0", category="validity"),
        expect_match_regex("transaction_id", r"^TXN-[A-Z0-9]{8,}$", priority="P1", category="format"),
        expect_mean("amount", 1000, 500000, priority="P1", category="distribution"),
        expect_unique_proportion("user_id", 0.001, 1.0, priority="P2", category="distribution"),
    ]


def with_columns(rules: Sequence[Rule], mapping: Mapping[str, str]) -> list[Rule]:
    """The same rules over other column names."""
    return [replace(r, column=mapping.get(r.column, r.column), other=mapping.get(r.other, r.other)) for r in rules]


def with_user_created_at(events: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``user_created_at`` from the users table (one row per user); a busy user is spread over tasks."""
    created = users.select("user_id", F.col("created_at").alias("user_created_at"))
    return join_dimension(events, created, "user_id")


def _in_range(value: Column, rule: Rule) -> Column:
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & ((value > rule.low) if rule.strict_low else (value >= rule.low))
    if rule.high is not None:
        ok = ok & (value <= rule.high)
    return ok


def _row_test(rule: Rule) -> tuple[Column, Column]:
    """(rows the rule looks at, rows that break it)."""
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return F.lit(True), c.isNull()
    present = c.isNotNull()
    if rule.kind == "match_regex":
        return present, present & ~c.rlike(rule.regex)
    if rule.kind == "in_set":
        return present, present & ~c.isin(*rule.values)
    if rule.kind == "between":
        return present, present & ~_in_range(c, rule)
    if rule.kind == "pair_a_ge_b":
        both = present & F.col(rule.other).isNotNull()
        return both, both & (c < F.col(rule.other))
    raise ValueError(f"unknown rule kind {rule.kind}")


def _measures(rule: Rule, i: int) -> list[Column]:
    none = F.max(F.lit(None).cast("bigint"))
    if rule.kind == "row_count":
        return [F.count(F.lit(1)).cast("double").alias(f"o_{i}"), none.alias(f"s_{i}"), none.alias(f"u_{i}")]
    if rule.kind == "mean":
        return [F.avg(rule.column).cast("double").alias(f"o_{i}"), none.alias(f"s_{i}"), none.alias(f"u_{i}")]
    seen, broken = _row_test(rule)
    return [
        F.max(F.lit(None).cast("double")).alias(f"o_{i}"),
        F.count_if(seen).alias(f"s_{i}"),
        F.count_if(broken).alias(f"u_{i}"),
    ]


def _distinct_rows(df: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """Rules about distinct values: the (column, value) pairs of all their columns are counted together, in one pass.

    A value that fills a column is one row per map task. The second sum goes over one row per column and value.
    """
    columns = list(dict.fromkeys(r.column for _, r in rules))
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("k")) for c in columns])
    known, n = F.col("k").isNotNull(), F.col("n")

    def summed(rows: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(rows, n)), F.lit(0)).alias(name)

    counted = df.select(F.inline(pairs)).groupBy("c", "k").agg(F.count(F.lit(1)).alias("n"))
    measures = [summed(F.lit(True), "total"), summed(known, "seen"), F.count("k").alias("keys"), summed(known & (n > 1), "repeated")]
    # a column of an empty table has no pair
    empty = df.sparkSession.createDataFrame([(c,) for c in columns], "c string")
    totals = empty.join(counted.groupBy("c").agg(*measures), "c", "left").fillna(0)
    none = F.lit(None).cast("bigint")
    rows = []
    for i, rule in rules:
        unique = rule.kind == "unique"
        observed = F.lit(None).cast("double") if unique else ratio(F.col("keys"), F.col("seen"))
        entry = F.struct(
            F.lit(i).alias("rule_no"),
            observed.alias("observed_value"),
            F.col("total").alias("element_count"),
            (F.col("seen") if unique else none).alias("seen"),
            (F.col("repeated") if unique else none).alias("unexpected_count"),
        )
        rows.append(F.when(F.col("c") == rule.column, entry))
    return totals.select(F.inline(F.array_compact(F.array(*rows))))


def dq_suite_run(
    df: DataFrame,
    rules: Sequence[Rule],
    suite: str,
    partition_date: Day | None = None,
    date_column: str = "event_timestamp",
    plain: DataFrame | None = None,
) -> DataFrame:
    """One row per rule: what was observed, how many rows broke it, and whether it holds.

    ``plain`` is the frame before columns were looked up for some rules (the same rows): uniqueness rules read it, so the
    lookup is not repeated for each of them.
    """
    plain = df if plain is None else plain
    if partition_date is not None:
        df, plain = (x.filter(on_day(date_column, partition_date)) for x in (df, plain))
    numbered = list(enumerate(rules, 1))
    simple = [(i, r) for i, r in numbered if r.kind not in _DISTINCT_KINDS]
    parts = []
    if simple:
        entries = [
            F.struct(
                F.lit(i).alias("rule_no"),
                F.col(f"o_{i}").alias("observed_value"),
                F.col("_rows").alias("element_count"),
                F.col(f"s_{i}").alias("seen"),
                F.col(f"u_{i}").alias("unexpected_count"),
            )
            for i, _ in simple
        ]
        measures = [m for i, r in simple for m in _measures(r, i)]
        parts.append(df.agg(F.count(F.lit(1)).alias("_rows"), *measures).select(F.inline(F.array(*entries))))
    chosen = [(i, r) for i, r in numbered if r.kind in _DISTINCT_KINDS]
    if chosen:
        parts.append(_distinct_rows(plain, chosen))
    measured = reduce(DataFrame.unionByName, parts)

    def by_rule(value) -> Column:
        """A constant per rule number."""
        pairs = [x for i, r in numbered for x in (F.lit(i), value(r))]
        return F.element_at(F.create_map(*pairs), F.col("rule_no"))

    observed, seen, broken = F.col("observed_value"), F.col("seen"), F.col("unexpected_count")
    kept = F.coalesce(ratio(seen - broken, seen), F.lit(1.0))
    row_ok = kept >= by_rule(lambda r: F.lit(float(r.mostly)))
    low = by_rule(lambda r: F.lit(None if r.low is None else float(r.low)).cast("double"))
    high = by_rule(lambda r: F.lit(None if r.high is None else float(r.high)).cast("double"))
    value_ok = F.coalesce((observed >= low) & (observed <= high), F.lit(False))
    about_rows = by_rule(lambda r: F.lit(r.kind not in ("row_count", "mean", "unique_proportion")))
    return measured.select(
        F.lit(suite).alias("suite"),
        "rule_no",
        by_rule(lambda r: F.lit(r.kind)).alias("expectation"),
        by_rule(lambda r: F.lit(r.column).cast("string")).alias("column"),
        by_rule(lambda r: F.lit(r.priority)).alias("priority"),
        by_rule(lambda r: F.lit(r.category)).alias("category"),
        "observed_value",
        "element_count",
        "unexpected_count",
        (ratio(broken, seen) * 100).alias("unexpected_percent"),
        F.when(about_rows, row_ok).otherwise(value_ok).alias("success"),
    )
