"""Table checks: freshness, volume, nulls, duplicates. Each check is a row of one fixed shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.exprs import Day, day, moment, on_day, pct, ratio, since_day, whole_minutes

CRITICAL_CHECKS = ("freshness", "volume_anomaly")


class CriticalQualityFailure(RuntimeError):
    """A freshness or volume check failed."""


def _check(name: str | Column, table: str, status: Column, metric: Column, threshold: float, details: Column, at: Column):
    return [
        (F.lit(name) if isinstance(name, str) else name).alias("check_name"),
        F.lit(table).alias("table_name"),
        status.alias("status"),
        metric.cast("double").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold"),
        details.alias("details"),
        at.alias("checked_at"),
    ]


def dq_freshness(
    df: DataFrame, table: str, as_of_ts: str, max_delay_minutes: int = 30, column: str = "ingested_at"
) -> DataFrame:
    """Minutes since the last row came in, against the allowed delay; 80 % of it is a warning."""
    m = F.col("m")
    limit = max_delay_minutes
    status = (
        F.when(m.isNull() | (m > limit), "FAIL").when(m > limit * 0.8, "WARN").otherwise("PASS")
    )
    details = (
        F.when(m.isNull(), "the table is empty")
        .otherwise(F.format_string(f"last arrival %d min ago, at most {limit} min allowed", m))
    )
    at = moment(as_of_ts)
    return df.agg(whole_minutes(F.max(column), at).alias("m")).select(
        *_check("freshness", table, status, m, limit, details, at)
    )


def dq_volume_zscore(
    df: DataFrame,
    table: str,
    as_of: Day,
    date_column: str = "event_timestamp",
    threshold: float = 2.0,
    days: int = 14,
    exclude_tested_day: bool = False,
) -> DataFrame:
    """Deviation of the last full day from the mean of the days before ``as_of``.

    The tested day is part of its own baseline unless it is excluded. Rows are counted per day first; the
    statistics and the tested count then come from one aggregation over those few rows.
    """
    last = day(as_of)
    tested = F.col("dt") == F.lit(last - timedelta(days=1))
    base = F.col("dt") < F.lit(last)
    if exclude_tested_day:
        base = base & ~tested
    daily = (
        df.filter(since_day(date_column, last - timedelta(days=days)))
        .groupBy(F.to_date(date_column).alias("dt"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stats = daily.agg(
        F.max(F.when(tested, F.col("n"))).alias("today"),
        F.avg(F.when(base, F.col("n"))).alias("mean"),
        F.stddev(F.when(base, F.col("n"))).alias("std"),
    ).withColumn("z", F.coalesce(ratio(F.abs(F.col("today") - F.col("mean")), F.col("std")), F.lit(0.0)))
    z, today, mean = F.col("z"), F.col("today"), F.col("mean")
    missing = today.isNull()
    status = F.when(missing, "WARN").when(z > threshold, "FAIL").otherwise("PASS")
    count, average = F.format_number(today, 0), F.format_number(mean, 0)
    details = (
        F.when(missing, "no rows on the day before")
        .otherwise(F.format_string("%s rows against a mean of %s, %.2f deviations away", count, average, z))
    )
    return stats.select(
        *_check("volume_anomaly", table, status, F.when(~missing, z), threshold, details, moment(str(last)))
    )


def dq_null_rates(
    df: DataFrame,
    table: str,
    columns: Sequence[str],
    date: Day,
    max_null_rate: float = 0.05,
    date_column: str = "event_timestamp",
) -> DataFrame:
    """Null rate of each column on one day; all columns come from one pass."""
    rows = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"r_{i}").alias("r")) for i, c in enumerate(columns)])
    rates = (
        df.filter(on_day(date_column, date))
        .agg(*[F.avg(F.col(c).isNull().cast("int")).alias(f"r_{i}") for i, c in enumerate(columns)])
        .select(F.inline(rows))
    )
    r = F.col("r")
    bad = r > max_null_rate
    share = F.format_string(f"%s is missing in %.2f%% of rows, {max_null_rate:.2%}% allowed", F.col("c"), r * 100)
    details = F.when(r.isNull(), "no rows to look at").otherwise(share)
    status = F.when(r.isNull(), "WARN").when(bad, "FAIL").otherwise("PASS")
    name = F.concat(F.lit("null_rate_"), F.col("c"))
    return rates.select(*_check(name, table, status, r, max_null_rate, details, moment(str(day(date)))))


def dq_duplicate_rate(
    df: DataFrame,
    table: str,
    key: str,
    date: Day,
    max_rate: float = 0.01,
    date_column: str = "event_timestamp",
) -> DataFrame:
    """Share of rows of one day whose key was already counted."""
    counts = (
        df.filter(on_day(date_column, date))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("rows"), F.count(key).alias("keys"))
    )
    rate = F.lit(1.0) - ratio(F.col("keys"), F.col("rows"))
    d = F.col("d")
    details = F.when(d.isNull(), "no rows to look at").otherwise(
        F.format_string("%d rows repeat a key (%.4f%%)", F.col("rows") - F.col("keys"), d * 100)
    )
    status = F.when(d.isNull(), "WARN").when(d > max_rate, "FAIL").otherwise("PASS")
    return counts.withColumn("d", rate).select(
        *_check("duplicate_rate", table, status, d, max_rate, details, moment(str(day(date))))
    )


def dq_run_all(user_events: DataFrame, cdc_orders: DataFrame, as_of_ts: str, orders_as_of_ts: str | None = None) -> DataFrame:
    """The standard set of checks over the raw tables."""
    at, at_orders = as_of_ts, orders_as_of_ts or as_of_ts
    as_of, as_of_orders = day(at[:10]), day(at_orders[:10])
    yesterday = as_of - timedelta(days=1)
    parts = [
        dq_freshness(user_events, "user_events", at, 30),
        dq_freshness(cdc_orders, "cdc_orders", at_orders, 15),
        dq_volume_zscore(user_events, "user_events", as_of),
        dq_volume_zscore(cdc_orders, "cdc_orders", as_of_orders, "cdc_timestamp"),
        dq_null_rates(user_events, "user_events", ("user_id", "session_id", "event_type"), yesterday),
        dq_duplicate_rate(user_events, "user_events", "event_id", yesterday),
    ]
    return reduce(DataFrame.unionByName, parts)


def dq_summary(checks: DataFrame) -> DataFrame:
    """One row: checks by status, and whether a critical one failed."""
    status = F.col("status")
    return checks.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "PASS").alias("passed"),
        F.count_if(status == "WARN").alias("warnings"),
        F.count_if(status == "FAIL").alias("failed"),
        F.count_if((status == "FAIL") & F.col("check_name").isin(*CRITICAL_CHECKS)).alias("critical"),
    )


def raise_on_critical(checks: DataFrame) -> None:
    """Stop a job when a critical check failed. Reads one summary row."""
    row = dq_summary(checks).first()
    if row["critical"]:
        raise CriticalQualityFailure(f"{row['critical']} critical of {row['failed']} failed quality checks")


def pipeline_freshness(tables: Mapping[str, tuple[DataFrame, str, str]], as_of_ts: str) -> DataFrame:
    """Per table (frame, ingestion column, date column): last arrival, age, rows and days covered."""
    parts = []
    for name, (df, ingested, stamp) in tables.items():
        per_day = df.groupBy(F.to_date(stamp).alias("d")).agg(
            F.max(ingested).alias("last"), F.count(F.lit(1)).alias("n")
        )
        parts.append(
            per_day.agg(F.max("last").alias("last"), F.sum("n").alias("n"), F.count("d").alias("days")).select(
                F.lit(name).alias("table_name"),
                F.col("last").alias("last_ingested_at"),
                whole_minutes(F.col("last"), moment(as_of_ts)).alias("freshness_minutes"),
                F.coalesce("n", F.lit(0)).alias("total_rows"),
                F.col("days").alias("date_coverage"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def dq_volume_change(events: DataFrame, date: Day, threshold: float = 50.0, date_column: str = "event_timestamp") -> DataFrame:
    """Rows of a day against the day before; a change of more than ``threshold`` percent is an anomaly."""
    today, before = day(date), day(date) - timedelta(days=1)
    counts = events.filter(on_day(date_column, today) | on_day(date_column, before)).agg(
        F.count_if(on_day(date_column, today)).alias("today_count"),
        F.count_if(on_day(date_column, before)).alias("yesterday_count"),
    )
    change = F.coalesce(pct(F.col("today_count") - F.col("yesterday_count"), F.col("yesterday_count")), F.lit(0.0))
    return counts.withColumn("change_pct", F.round(change, 1)).withColumn("anomaly", F.abs(change) > threshold)


def schema_drift(df: DataFrame, expected: StructType) -> DataFrame:
    """Columns that are missing, unexpected or of another type, with the number of filled rows they have."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = [n for n in [*wanted, *[a for a in actual if a not in wanted]] if wanted.get(n) != actual.get(n)]
    if not names:
        return df.limit(0).select(
            F.lit("").alias("column"), F.lit("").alias("expected"), F.lit("").alias("actual"),
            F.lit(0).cast("bigint").alias("filled_rows"),
        )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column"),
                F.lit(wanted.get(n)).cast("string").alias("expected"),
                F.lit(actual.get(n)).cast("string").alias("actual"),
                F.col(f"n_{i}").alias("filled_rows"),
            )
            for i, n in enumerate(names)
        ]
    )
    filled = [
        (F.count(F.col(f"`{n}`")) if n in actual else F.lit(0).cast("bigint")).alias(f"n_{i}")
        for i, n in enumerate(names)
    ]
    return df.agg(F.count(F.lit(1)), *filled).select(F.inline(rows))


# ---- operational metrics


def run_counters(run_log: DataFrame) -> DataFrame:
    """Runs, rows, errors and seconds per pipeline and status from the run log."""
    return run_log.groupBy("pipeline_name", "status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("rows_processed").alias("rows_processed"),
        F.count("error_type").alias("errors"),
        F.sum("duration_sec").alias("duration_sec"),
    )


def quality_gauges(checks: DataFrame) -> DataFrame:
    """Gauge values of check records: status (1 = pass) for all, and the metric under its gauge name."""
    name = F.col("check_name")
    gauge = (
        F.when(name == "freshness", "data_freshness_minutes")
        .when(name.startswith("null_rate_"), "data_null_rate")
        .when(name == "volume_anomaly", "data_volume_zscore")
    )
    column = F.when(name.startswith("null_rate_"), F.substring_index(name, "null_rate_", -1))
    passed = F.when(F.col("status") == "PASS", F.lit(1.0)).otherwise(F.lit(0.0))
    entries = F.array(
        F.struct(F.lit("data_quality_check_status").alias("gauge"), F.lit(None).cast("string").alias("column_name"), passed.alias("value")),
        F.when(gauge.isNotNull(), F.struct(gauge.alias("gauge"), column.alias("column_name"), F.col("metric_value").alias("value"))),
    )
    return checks.select("check_name", "table_name", F.inline(F.array_compact(entries)))


def sla_alerts(counters: DataFrame, freshness: DataFrame, max_minutes: int = 30) -> DataFrame:
    """Alerts: stale tables are critical, failed runs a warning."""
    stale = freshness.filter(F.col("freshness_minutes") > max_minutes).select(
        F.lit("DataFreshnessSLABreach").alias("alert"),
        F.lit("critical").alias("severity"),
        F.col("table_name").alias("subject"),
        F.col("freshness_minutes").cast("double").alias("value"),
    )
    failed = counters.filter((F.col("status") == "error") & (F.col("runs") > 0)).select(
        F.lit("PipelineExecutionFailed").alias("alert"),
        F.lit("warning").alias("severity"),
        F.col("pipeline_name").alias("subject"),
        F.col("runs").cast("double").alias("value"),
    )
    return stale.unionByName(failed)
