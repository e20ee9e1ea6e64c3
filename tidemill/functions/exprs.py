"""Column helpers. Everything here stays inside Catalyst expressions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = str | date


def day(value: Day) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def moment(value: str | datetime) -> Column:
    return F.lit(str(value)).cast("timestamp")


def days_before(as_of: Day, n: int) -> Column:
    """Literal date, computed on the driver so that it folds into the scan filter."""
    return F.lit(day(as_of) - timedelta(days=n))


def on_day(ts: str, value: Day) -> Column:
    """Rows of one calendar day as a timestamp range, which reaches the Parquet filter."""
    start = day(value)
    return between_days(ts, start, start)


def between_days(ts: str, first: Day, last: Day) -> Column:
    lo = F.lit(day(first).isoformat()).cast("timestamp")
    hi = F.lit((day(last) + timedelta(days=1)).isoformat()).cast("timestamp")
    return (F.col(ts) >= lo) & (F.col(ts) < hi)


def since_day(ts: str, first: Day) -> Column:
    return F.col(ts) >= F.lit(day(first).isoformat()).cast("timestamp")


def ratio(num: Column, den: Column) -> Column:
    """Division that is NULL on a zero or NULL denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column) -> Column:
    return ratio(num, den) * F.lit(100.0)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def any_flag(condition: Column) -> Column:
    return F.max(flag(condition))


def whole_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def whole_minutes(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def sunday_week(d: Column) -> Column:
    """First day of a week that starts on Sunday."""
    return F.date_sub(d, F.dayofweek(d) - F.lit(1))


def json_scalar(text: Column, key: str) -> Column:
    """Scalar member of a JSON object as text; NULL for bad JSON, objects and arrays."""
    value = F.get_json_object(text, f"$.{key}")
    nested = value.startswith("{") | value.startswith("[")
    return F.when(~nested, value)


def typed(value: Column, type_name: str) -> Column:
    """Cast text that may be dirty: NULL instead of an error."""
    if type_name == "string":
        return value
    if type_name == "timestamp":
        return F.try_to_timestamp(value)
    return value.try_cast(type_name)


def as_json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})
