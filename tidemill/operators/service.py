"""Service metrics of the payment app: conversion, success and error rates, snapshots, volume."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.exprs import Day, any_flag, between_days, day, flag, pct, ratio
from tidemill.operators.payments import CHECKOUT, LOGIN, REFUND, SUCCESS

_DT = "dt"


def _by_day(events: DataFrame) -> DataFrame:
    return events.withColumn(_DT, F.to_date("event_timestamp"))


def _action(category: str, *actions: str) -> Column:
    return (F.col("event_category") == category) & F.col("event_action").isin(*actions)


def payment_conversion_rate(events: DataFrame) -> DataFrame:
    """Sessions with a successful payment per session that saw the checkout screen, per day."""
    return (
        _by_day(events)
        .groupBy(_DT, "session_id")
        .agg(
            any_flag(F.col("event_name") == SUCCESS).alias("done"),
            any_flag(F.col("event_name") == CHECKOUT).alias("seen"),
        )
        .groupBy(_DT)
        .agg(F.sum("done").alias("complete_sessions"), F.sum("seen").alias("checkout_sessions"))
        .withColumn("payment_cvr_pct", pct(F.col("complete_sessions"), F.col("checkout_sessions")))
    )


def transfer_success_rate(events: DataFrame, sla: float = 99.5) -> DataFrame:
    """Completed share of finished transfers per day, and whether it meets the target."""
    rate = pct(F.col("completed"), F.col("completed") + F.col("failed"))
    return (
        _by_day(events.filter(F.col("event_category") == "transfer"))
        .groupBy(_DT)
        .agg(
            F.count_if(_action("transfer", "complete")).alias("completed"),
            F.count_if(_action("transfer", "fail")).alias("failed"),
        )
        .withColumn("success_rate_pct", rate)
        .withColumn("sla_met", F.col("success_rate_pct") >= sla)
    )


def error_rate(events: DataFrame, sla: float = 1.0) -> DataFrame:
    """Errors per hundred sessions and day, and whether it stays below the target."""
    return (
        _by_day(events)
        .groupBy(_DT, "session_id")
        .agg(F.sum(flag(_action("error", "occur"))).alias("errors"))
        .groupBy(_DT)
        .agg(F.sum("errors").alias("error_events"), F.count("session_id").alias("sessions"))
        .withColumn("error_rate_pct", pct(F.col("error_events"), F.col("sessions")))
        .withColumn("sla_met", F.col("error_rate_pct") < sla)
    )


# Metric, event category, actions of the numerator, actions of the denominator.
DOMAIN_RULES = (
    ("login_success_rate", "auth", ("complete",), ("complete", "fail")),
    ("transfer_completion_rate", "transfer", ("complete",), ("complete", "fail")),
    ("invest_conversion_rate", "invest", ("subscribe",), ("view",)),
    ("points_use_rate", "benefit", ("use",), ("earn",)),
    ("notification_ctr", "notification", ("click",), ("receive",)),
    ("onboarding_completion_rate", "onboarding", ("complete",), ("view",)),
)
Rule = tuple[str, str, Sequence[str], Sequence[str]]


def domain_rates(events: DataFrame, rules: Sequence[Rule] = DOMAIN_RULES) -> DataFrame:
    """One row per day and metric: numerator, denominator and rate; plus the average transfer amount.

    All metrics come from one pass over the events.
    """
    sums = []
    for name, category, top, bottom in rules:
        sums.append(F.sum(flag(_action(category, *top))).alias(f"{name}_n"))
        sums.append(F.sum(flag(_action(category, *bottom))).alias(f"{name}_d"))
    done = _action("transfer", "complete")
    amount = F.col("properties.amount")
    sums.append(F.sum(F.when(done, amount)).alias("avg_transfer_amount_n"))
    sums.append(F.count(F.when(done, amount)).alias("avg_transfer_amount_d"))
    names = [r[0] for r in rules]

    def entry(name: str, scale: float) -> Column:
        n, d = F.col(f"{name}_n"), F.col(f"{name}_d")
        return F.struct(
            F.lit(name).alias("metric"),
            F.coalesce(n, F.lit(0)).cast("bigint").alias("numerator"),
            d.cast("bigint").alias("denominator"),
            (ratio(n, d) * F.lit(scale)).alias("value"),
        )

    rows = F.array(*[entry(n, 100.0) for n in names], entry("avg_transfer_amount", 1.0))
    return _by_day(events).groupBy(_DT).agg(*sums).select(_DT, F.inline(rows))


def hourly_volume_band(
    events: DataFrame, as_of: Day, band: float = 0.3, baseline_days: int = 14
) -> DataFrame:
    """Yesterday's events per hour against the mean of the days before, and the side of the band it is on."""
    tested = day(as_of) - timedelta(days=1)
    is_tested = F.col("d") == F.lit(tested)
    hourly = (
        events.filter(between_days("event_timestamp", tested - timedelta(days=baseline_days), tested))
        .groupBy(F.to_date("event_timestamp").alias("d"), F.hour("event_timestamp").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hour")
        .agg(
            F.sum(F.when(is_tested, F.col("n")).otherwise(0)).alias("events"),
            (F.sum(F.when(~is_tested, F.col("n")).otherwise(0)) / F.lit(float(baseline_days))).alias("expected"),
        )
    )
    low, high = F.col("expected") * (1 - band), F.col("expected") * (1 + band)
    status = F.when(F.col("events") < low, "below").when(F.col("events") > high, "above").otherwise("within")
    return hourly.select("hour", "events", "expected", low.alias("low"), high.alias("high"), status.alias("status"))


# ---- the named sets every metric is built from


def active_user_set(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_name") == LOGIN)


def transaction_set(events: DataFrame) -> DataFrame:
    return events.filter((F.col("event_name") == SUCCESS) | F.col("event_name").like("transfer.complete.%"))


def paying_user_set(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_name") == SUCCESS)


def revenue_set(events: DataFrame) -> DataFrame:
    """Payments as positive and refunds as negative amounts."""
    amount = F.col("properties.amount")
    return events.filter(F.col("event_name").isin(SUCCESS, REFUND)).withColumn(
        "signed_amount", F.when(F.col("event_name") == REFUND, -amount).otherwise(amount)
    )


def first_day_set(events: DataFrame) -> DataFrame:
    """First login day of every user."""
    return active_user_set(events).groupBy("user_id").agg(F.to_date(F.min("event_timestamp")).alias("first_day"))


def metric_base_sets(events: DataFrame) -> DataFrame:
    """Size of each named set per day; for revenue, the net amount. One pass, reduced per user and day first."""
    amount = F.coalesce(F.col("properties.amount"), F.lit(0))
    name = F.col("event_name")
    login, paid = any_flag(name == LOGIN), any_flag(name == SUCCESS)
    per_user = (
        _by_day(events)
        .groupBy(_DT, "user_id")
        .agg(
            login.alias("login"),
            paid.alias("paid"),
            F.sum(flag((name == SUCCESS) | name.like("transfer.complete.%"))).alias("transactions"),
            F.sum(F.when(name == SUCCESS, amount).when(name == REFUND, -amount).otherwise(0)).alias("revenue"),
        )
    )
    # a user has one row per day here
    first = F.min(F.when(F.col("login") == 1, F.col(_DT))).over(Window.partitionBy("user_id"))
    per_day = (
        per_user.withColumn("_new", flag(first == F.col(_DT)))
        .groupBy(_DT)
        .agg(
            F.sum("login").alias("active_user"),
            F.sum("transactions").alias("transaction"),
            F.sum("paid").alias("paying_user"),
            F.sum("revenue").alias("revenue"),
            F.sum("_new").alias("first_day"),
        )
    )
    sets = ("active_user", "transaction", "paying_user", "revenue", "first_day")
    rows = F.array(*[F.struct(F.lit(s).alias("set_name"), F.col(s).cast("bigint").alias("value")) for s in sets])
    return per_day.select(_DT, F.inline(rows))


def kpi_snapshot(
    active: DataFrame, revenue: DataFrame, funnel: DataFrame, retention: DataFrame, as_of: Day
) -> DataFrame:
    """Headline figures of yesterday with their change to the day before (D7 retention: to the week before).

    The inputs hold one row per day, per day and device, or per cohort and day.
    """
    yesterday = day(as_of) - timedelta(days=1)

    def pair(df: DataFrame, date_col: str, now: Day, before: Day, names: dict[str, Column]) -> DataFrame:
        at = F.col(date_col)
        kept = df.filter(at.isin(day(now), day(before)))
        parts = []
        for name, value in names.items():
            parts.append(F.max(F.when(at == F.lit(now), value)).alias(f"{name}_now"))
            parts.append(F.max(F.when(at == F.lit(before), value)).alias(f"{name}_before"))
        rows = F.array(
            *[
                F.struct(
                    F.lit(n).alias("kpi"),
                    F.col(f"{n}_now").cast("double").alias("value"),
                    F.col(f"{n}_before").cast("double").alias("previous"),
                )
                for n in names
            ]
        )
        return kept.agg(*parts).select(F.inline(rows))

    overall = funnel.groupBy(_DT).agg(
        pct(F.sum("step4_payment_complete"), F.sum("step1_payment_view")).alias("cvr")
    )
    before = yesterday - timedelta(days=1)
    d7 = retention.filter(F.col("day_n") == 7)
    week = timedelta(days=7)
    snapshot = (
        pair(active, _DT, yesterday, before, {"dau": F.col("dau")})
        .unionByName(
            pair(
                revenue, _DT, yesterday, before, {"net_revenue": F.col("net_revenue"), "arppu": F.col("arppu")}
            )
        )
        .unionByName(pair(overall, _DT, yesterday, before, {"payment_cvr": F.col("cvr")}))
        .unionByName(
            pair(
                d7,
                "cohort_date",
                yesterday - week,
                yesterday - 2 * week,
                {"d7_retention": F.col("retention_rate")},
            )
        )
    )
    return snapshot.withColumn("change_pct", pct(F.col("value") - F.col("previous"), F.col("previous")))
