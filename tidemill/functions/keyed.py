"""Keyed helpers that keep a hot key from landing whole in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    The ``row_number() = 1`` form lets Spark put a group limit in front of the shuffle, so every map task
    ships at most one row per key. A key that holds a third of all rows costs one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """At most ``n`` rows per key with their 1-based ``_rank``; limited before the shuffle as above."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n)


def next_in_group(
    df: DataFrame,
    group: str,
    ts: str,
    tie_break: str,
    carry: Sequence[str],
    slice_length: str = "10 minutes",
) -> DataFrame:
    """``LEAD`` of the ``carry`` columns and of ``ts`` inside a group, without one task per group.

    A plain window sorts a whole group in one task. Here the group is cut into time slices first: the lead
    inside a slice needs only the slice, and the lead across slices needs only the first and the last row of
    each slice. The second window therefore sees at most two rows per slice, however large the group is.
    Both branches read the same shuffled data, which Spark reuses. The last row of a group has no next row
    and is left out.
    """
    fields = [*carry, ts]
    following = F.struct(*[F.col(c) for c in fields])
    within = Window.partitionBy(group, "_slice").orderBy(ts, tie_break)
    sliced = (
        df.withColumn("_slice", F.window(F.col(ts), slice_length).start)
        .withColumn("_next", F.lead(following).over(within))
        .withColumn("_first", F.row_number().over(within) == 1)
    )
    inside = sliced.filter(F.col("_next").isNotNull())
    across = Window.partitionBy(group).orderBy(ts, tie_break)
    edges = (
        sliced.filter(F.col("_first") | F.col("_next").isNull())
        .withColumn("_last", F.col("_next").isNull())
        .withColumn("_next", F.lead(following).over(across))
        .filter(F.col("_last") & F.col("_next").isNotNull())
        .drop("_last")
    )
    both = inside.unionByName(edges)
    return both.select(
        *df.columns, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in fields]
    )


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join facts with a table that has one row per key, safe for a key that holds a third of the facts.

    Nothing is repeated and nothing forced: Spark broadcasts the smaller side only if its own estimate of that side's size
    stays below its threshold, and otherwise splits the partitions of a hot key when it sees their sizes. Both sides
    should be free of an aggregation on ``key`` directly below, which would pin the partitions.
    """
    return facts.join(dimension, key, how)


def rolling_distinct(
    user_days: DataFrame, user: str, dt: str, windows: dict[str, int], day_sums: Sequence[str] = ()
) -> DataFrame:
    """Exact distinct users per trailing window, for every day with at least one user.

    ``user_days`` holds each (user, day) once. A user-day makes its user count from that day until the window
    length has passed or the user's next active day takes over, so it contributes +1 at the start and -1 after
    the end of that span. Summing the steps per day and accumulating over days gives the exact count: no row
    is multiplied by the window length and no user set is held. The accumulation runs over one row per
    calendar day. ``day_sums`` are integer columns of ``user_days`` summed over the day itself.
    """
    by_user = Window.partitionBy(user).orderBy(dt)
    spans = user_days.withColumn("_next_day", F.lead(dt).over(by_user))
    names = list(windows)
    today = {"_today": F.lit(1), **{c: F.col(c) for c in day_sums}}
    steps = [
        F.struct(
            F.col(dt).alias("_d"),
            *[v.cast("bigint").alias(c) for c, v in today.items()],
            *[F.lit(1).cast("bigint").alias(n) for n in names],
        )
    ]
    for name, length in windows.items():
        end = F.least(F.date_add(F.col(dt), length), F.col("_next_day"))
        steps.append(
            F.struct(
                end.alias("_d"),
                *[F.lit(0).cast("bigint").alias(c) for c in today],
                *[F.lit(-1 if n == name else 0).cast("bigint").alias(n) for n in names],
            )
        )
    per_day = (
        spans.select(F.inline(F.array(*steps)))
        .groupBy("_d")
        .agg(*[F.sum(c).alias(c) for c in (*today, *names)])
    )
    running = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        per_day.select(
            F.col("_d").alias(dt), *today, *[F.sum(n).over(running).alias(n) for n in names]
        )
        .filter(F.col("_today") > 0)
        .withColumnRenamed("_today", "daily_distinct")
    )
