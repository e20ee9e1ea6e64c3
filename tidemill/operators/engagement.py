"""Logins: retention, active users, cohorts.

Logins are reduced to one row per user and day by a hash aggregation first. A user then has at most as many rows as the
input has calendar days (the staging look-back), and retention needs no self-join: the cohort is the first day of the
user's window, and the users back on day 0 are the cohort itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.exprs import Day, day, pct, since_day, sunday_week
from tidemill.functions.keyed import rolling_distinct
from tidemill.operators.staging import logins


def _returns(events: DataFrame, max_day: int, cohort_from: Day | None, first_in_range: Day | None = None) -> DataFrame:
    """Users back per (cohort_date, day_n).

    ``cohort_from`` keeps cohorts from that date on. With ``first_in_range`` the cohort is the first login on
    or after that date, instead of the first ever.
    """
    user_days = logins(events).select("user_id", F.to_date("event_timestamp").alias("d")).distinct()
    if first_in_range is not None:
        user_days = user_days.filter(F.col("d") >= F.lit(day(first_in_range)))
    # a user has at most one row per calendar day here
    cohort = F.min("d").over(Window.partitionBy("user_id"))
    days = user_days.filter(F.col("d").isNotNull()).withColumn("cohort_date", cohort)
    days = days.withColumn("day_n", F.date_diff("d", "cohort_date")).filter(F.col("day_n") <= max_day)
    if cohort_from is not None:
        days = days.filter(F.col("cohort_date") >= F.lit(day(cohort_from)))
    return days.groupBy("cohort_date", "day_n").agg(F.count(F.lit(1)).alias("returned_users"))


def _with_cohort_size(returns: DataFrame) -> DataFrame:
    size = F.max(F.when(F.col("day_n") == 0, F.col("returned_users"))).over(Window.partitionBy("cohort_date"))
    return returns.withColumn("cohort_users", size).withColumn(
        "retention_rate", pct(F.col("returned_users"), F.col("cohort_users"))
    )


def mart_user_retention(events: DataFrame, as_of: Day, max_day: int = 30, cohort_days: int = 60) -> DataFrame:
    """Users back per cohort and day for the cohorts of the last ``cohort_days`` days."""
    returns = _returns(events, max_day, day(as_of) - timedelta(days=cohort_days))
    return _with_cohort_size(returns).select(
        "cohort_date", "cohort_users", "day_n", "returned_users", "retention_rate"
    )


# Login days a user's row can hold, from the first one on: the bits of a bigint but for its sign.
KEPT_DAYS = 63


def login_days(events: DataFrame) -> DataFrame:
    """One row per user: ``first_day`` of a login and ``days``, whose bit i says that there was one i days later.

    Days beyond the 63rd are not held; retention looks 30 days ahead. A user's days are distinct before they meet, so they
    are at most as many as the input has calendar days.
    """
    user_days = logins(events).select("user_id", F.to_date("event_timestamp").alias("d")).filter("d IS NOT NULL").distinct()
    seen = user_days.groupBy("user_id").agg(F.min("d").alias("first_day"), F.collect_list("d").alias("_days"))
    offsets = F.transform("_days", lambda d: F.date_diff(d, F.col("first_day")))
    return seen.select("user_id", "first_day", _union_of_bits(offsets).alias("days"))


def merge_login_days(*parts: DataFrame) -> DataFrame:
    """The rows of several ``login_days``, of any days and in any order, as one: the same as from all their events at once.

    Each part has one row per user at most. A part whose first day is later moves up by the days between.
    """
    both = reduce(DataFrame.unionByName, [part.select("user_id", "first_day", "days") for part in parts])
    own = both.groupBy("user_id").agg(
        F.min("first_day").alias("_first"), F.collect_list(F.struct("first_day", "days")).alias("_parts")
    )
    shifted = F.transform(
        "_parts", lambda x: F.struct(F.date_diff(x["first_day"], F.col("_first")).alias("by"), x["days"].alias("days"))
    )
    near = F.filter(shifted, lambda x: x["by"] < KEPT_DAYS)
    kept = F.aggregate(
        near,
        F.lit(0).cast("bigint"),
        lambda bits, x: bits.bitwiseOR(_shift(x["days"], x["by"]).bitwiseAND(F.lit(2**KEPT_DAYS - 1))),
    )
    return own.select("user_id", F.col("_first").alias("first_day"), kept.alias("days"))


def retention_of_login_days(state: DataFrame, as_of: Day, max_day: int = 30, cohort_days: int = 60) -> DataFrame:
    """``mart_user_retention`` from the stored rows of ``login_days``: one row per user is read, no event.

    All days of a cohort are counted in one aggregation that combines on the map side.
    """
    if max_day >= KEPT_DAYS:
        raise ValueError(f"a row holds {KEPT_DAYS} days")
    recent = state.filter(F.col("first_day") >= F.lit(day(as_of) - timedelta(days=cohort_days)))
    counts = [F.count_if(F.getbit("days", F.lit(n)) == 1).alias(f"d{n}") for n in range(max_day + 1)]
    by_day = F.array(*[F.struct(F.lit(n).alias("day_n"), F.col(f"d{n}").alias("returned_users")) for n in range(max_day + 1)])
    returns = recent.groupBy(F.col("first_day").alias("cohort_date")).agg(*counts).select("cohort_date", F.inline(by_day))
    return _with_cohort_size(returns.filter("returned_users > 0")).select(
        "cohort_date", "cohort_users", "day_n", "returned_users", "retention_rate"
    )


def _shift(bits: Column, by: Column) -> Column:
    return F.call_function("shiftleft", bits, by)


def _union_of_bits(offsets: Column) -> Column:
    near = F.filter(offsets, lambda n: n < KEPT_DAYS)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return F.aggregate(near, none, lambda bits, n: bits.bitwiseOR(_shift(one, n)))


def retention_long(
    events: DataFrame,
    as_of: Day,
    cohort_days: int = 60,
    points: Sequence[int] = (1, 3, 7, 14, 30),
    max_day: int = 30,
) -> DataFrame:
    """The retention rows with the rates of the standard days repeated on each row of a cohort."""
    rows = mart_user_retention(events, as_of, max_day, cohort_days)
    cohort = Window.partitionBy("cohort_date")
    for n in points:
        rate = F.max(F.when(F.col("day_n") == n, F.col("retention_rate"))).over(cohort)
        rows = rows.withColumn(f"d{n}_retention", rate)
    return rows.orderBy(F.desc("cohort_date"), "day_n")


def retention_pivot(
    events: DataFrame,
    as_of: Day,
    days: int = 60,
    min_cohort: int = 50,
    points: Sequence[int] = (0, 1, 3, 7, 14, 30),
) -> DataFrame:
    """One row per cohort with the rounded rate of each standard day.

    A cohort is the first login inside the last ``days`` days, so an older user can start a new cohort.
    """
    returns = _returns(events, 30, None, first_in_range=day(as_of) - timedelta(days=days))
    wide = returns.groupBy("cohort_date").agg(
        F.max(F.when(F.col("day_n") == 0, F.col("returned_users"))).alias("cohort_size"),
        *[F.max(F.when(F.col("day_n") == n, F.col("returned_users"))).alias(f"d{n}") for n in points],
    )
    return (
        wide.filter(F.col("cohort_size") >= min_cohort)
        .select(
            "cohort_date",
            "cohort_size",
            *[F.round(pct(F.col(f"d{n}"), F.col("cohort_size")), 1).alias(f"d{n}") for n in points],
        )
        .orderBy(F.desc("cohort_date"))
    )


def retention_weekly_cohort(
    events: DataFrame,
    as_of: Day,
    cohort_days: int = 60,
    points: Sequence[int] = (0, 1, 3, 7, 14, 30),
) -> DataFrame:
    """Retention curve per cohort week (from Sunday): users of the week, and those back n days after their own start."""
    returns = _returns(events, max(points), day(as_of) - timedelta(days=cohort_days))
    weekly = returns.groupBy(sunday_week(F.col("cohort_date")).alias("cohort_week")).agg(
        F.sum(F.when(F.col("day_n") == 0, F.col("returned_users"))).alias("cohort_users"),
        *[F.sum(F.when(F.col("day_n") == n, F.col("returned_users"))).alias(f"u{n}") for n in points],
    )
    return weekly.select(
        "cohort_week",
        "cohort_users",
        *[pct(F.coalesce(F.col(f"u{n}"), F.lit(0)), F.col("cohort_users")).alias(f"d{n}") for n in points],
    )


def active_users(events: DataFrame, as_of: Day, days: int = 90, approx: bool = False) -> DataFrame:
    """Daily, 7-day and 30-day active users per day with at least one login, and daily users per device.

    ``approx`` swaps the exact count for one HyperLogLog sketch per day, merged over the trailing days; it
    avoids the shuffle of user-days and errs by about 1.6 %.
    """
    recent = logins(events).filter(since_day("event_timestamp", day(as_of) - timedelta(days=days)))
    devices = ("ios", "android", "web")
    per_device = [f"dau_{d}" for d in devices]
    windows = {"wau": 7, "mau": 30}
    dt = F.to_date("event_timestamp").alias("dt")
    if approx:
        result = _approx_active(recent, windows, devices)
    else:
        user_days = recent.groupBy(dt, "user_id").agg(
            *[
                F.max(F.when(F.col("device_type") == d, 1).otherwise(0)).alias(n)
                for d, n in zip(devices, per_device)
            ]
        )
        result = rolling_distinct(user_days, "user_id", "dt", windows, per_device).withColumnRenamed(
            "daily_distinct", "dau"
        )
    return result.select(
        "dt", "dau", "wau", "mau", pct(F.col("dau"), F.col("mau")).alias("stickiness_pct"), *per_device
    ).orderBy(F.desc("dt"))


def _approx_active(recent: DataFrame, windows: dict[str, int], devices: Sequence[str]) -> DataFrame:
    daily = recent.groupBy(F.to_date("event_timestamp").alias("dt")).agg(
        F.hll_sketch_agg("user_id", F.lit(12)).alias("sketch"),
        *[
            F.hll_sketch_estimate(
                F.hll_sketch_agg(F.when(F.col("device_type") == d, F.col("user_id")), F.lit(12))
            ).alias(f"dau_{d}")
            for d in devices
        ],
    )
    # one row per day from here on
    reach = F.explode(F.sequence(F.lit(0), F.lit(max(windows.values()) - 1))).alias("_ago")
    spread = daily.select("dt", "sketch", reach).withColumn("_target", F.date_add("dt", F.col("_ago")))
    rolled = spread.groupBy("_target").agg(
        *[
            F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("_ago") < n, F.col("sketch")))).alias(name)
            for name, n in windows.items()
        ]
    )
    return daily.withColumn("dau", F.hll_sketch_estimate("sketch")).join(
        rolled.withColumnRenamed("_target", "dt"), "dt"
    )
