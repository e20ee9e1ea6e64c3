"""Event collection: parse, enrich, validate and route event messages.

Every function works the same on batch and streaming input and uses built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tidemill.functions.exprs import flag
from tidemill.schemas import EVENT_MESSAGE, RAW_USER_EVENTS

# Supported event and device types.
EVENT_TYPES = (
    "page_view", "product_view", "product_click", "add_to_cart", "remove_from_cart", "begin_checkout",
    "purchase", "search", "search_click", "wishlist_add", "review_write", "app_open", "app_close",
    "push_click", "banner_click",
)
DEVICE_TYPES = ("ios", "android", "web_mobile", "web_desktop")
REQUIRED_KEYS = ("event_id", "event_type", "session_id")
MIN_EVENT_ID_LENGTH = 8
MAX_BATCH_SIZE = 500


def message_text(df: DataFrame, column: str = "value") -> Column:
    """The message as text; NULL where bytes are not valid UTF-8."""
    col = F.col(column)
    if isinstance(df.schema[column].dataType, BinaryType):
        return F.when(F.is_valid_utf8(col.cast("string")), col.cast("string"))
    return col


def _parsed(raw: DataFrame, *keep: str) -> DataFrame:
    """Message columns next to the ``keep`` columns; all NULL where the message is no JSON object.

    The generator makes Spark parse a message once: a plain filter on parsed columns would be pushed below the
    projection together with a copy of the parse for every column it mentions.
    """
    event = F.from_json(message_text(raw), EVENT_MESSAGE)
    return raw.select(*keep, F.inline(F.array(event)))


def _complete() -> Column:
    complete = F.lit(True)
    for key in REQUIRED_KEYS:
        complete = complete & F.col(key).isNotNull()
    return complete


def parse_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split messages into (events, dead letters).

    A message is an event when it is a JSON object in which the required keys are present and not null.
    """
    events = _parsed(raw).filter(_complete())
    dead = (
        _parsed(raw, "value")
        .filter(~_complete())
        .select(F.make_valid_utf8(F.col("value").cast("string")).alias("raw_data"))
    )
    return events, dead


def parse_counters(raw: DataFrame) -> DataFrame:
    """One row: parsed_ok, parse_errors."""
    return _parsed(raw).agg(
        F.count_if(_complete()).alias("parsed_ok"), F.count_if(~_complete()).alias("parse_errors")
    )


def enrich_events(events: DataFrame, now: Column | None = None, version: str = "1.0.0") -> DataFrame:
    """Normalise the type and derive date parts; an unusable timestamp falls back to ``now``.

    ``event_time`` is the time to window on: it is never null, so no event is lost to windowing in a batch. Streams
    window only rows whose own time is usable, see ``timed``.
    """
    now = F.current_timestamp() if now is None else now
    stamp = F.col("event_timestamp")
    if isinstance(events.schema["event_timestamp"].dataType, StringType):
        stamp = F.try_to_timestamp(stamp)
    return (
        events.withColumn("event_timestamp", stamp)
        .withColumn("event_type", F.lower("event_type"))
        .withColumn("event_time", F.coalesce("event_timestamp", now))
        .withColumn("event_date", F.to_date("event_time"))
        .withColumn("event_hour", F.hour("event_time").cast("bigint"))
        .withColumn("processed_at", now)
        .withColumn("pipeline_version", F.lit(version))
    )


def usable_time(events: DataFrame, tolerance: str = "1 hour") -> Column:
    """Whether a row's time may move a watermark: it was given, and lies at most ``tolerance`` after processing."""
    if not {"event_timestamp", "processed_at"} <= set(events.columns):
        return F.lit(True)
    limit = F.col("processed_at") + F.expr(f"INTERVAL {tolerance}")
    return F.coalesce(F.col("event_timestamp") <= limit, F.lit(False))


def timed(events: DataFrame, time_col: str, watermark: str) -> DataFrame:
    """Streaming rows with a usable time, under a watermark.

    The fallback to the processing time (``enrich_events``) and clocks that run ahead would carry the watermark past a
    backlog or a replay, whose rows were then late and lost. Such rows go down their own path: ``untimed``.
    """
    return events.filter(usable_time(events)).withWatermark(time_col, watermark)


def untimed(events: DataFrame) -> DataFrame:
    """The rows that ``timed`` leaves out of windows; in the raw table they stand under their processing date."""
    return events.filter(~usable_time(events))


def session_window_agg(events: DataFrame, window: str = "60 seconds", watermark: str | None = None) -> DataFrame:
    """Per fixed window and session: counts, types, first user and device, time span, purchase flag.

    ``event_types`` is bounded by the number of type names, because the set is merged map-side; every other
    measure is a plain partial aggregate.
    """
    if events.isStreaming:
        events = timed(events, "event_time", watermark or "10 minutes")
    order = F.struct("event_time", "event_id")
    return (
        events.groupBy(F.window("event_time", window).alias("_w"), "session_id")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.array_sort(F.collect_set("event_type")).alias("event_types"),
            F.min_by("user_id", order).alias("user_id"),
            F.min_by("device_type", order).alias("device_type"),
            F.min("event_time").alias("first_event_at"),
            F.max("event_time").alias("last_event_at"),
            F.max(F.col("event_type") == "purchase").alias("has_purchase"),
        )
        .select(
            "session_id", "event_count", "event_types", "user_id", "device_type", "first_event_at",
            "last_event_at", "has_purchase", F.col("_w.start").alias("window_start"),
        )
    )


def _errors(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]))


def validate_events(events: DataFrame) -> DataFrame:
    """Add ``errors``: the names of the collector rules an event breaks."""
    rules = {
        "event_id": F.length("event_id") >= MIN_EVENT_ID_LENGTH,
        "event_type": F.col("event_type").isin(*EVENT_TYPES),
        "device_type": F.col("device_type").isin(*DEVICE_TYPES),
        "session_id": F.col("session_id").isNotNull(),
    }
    return events.withColumn("errors", _errors(rules))


_TYPED = (
    "product_id bigint, product_name string, category string, price double, order_id bigint, "
    "total_amount double, item_count bigint, payment_method string, search_query string, result_count string"
)


def validate_typed_events(events: DataFrame) -> DataFrame:
    """Type-specific property rules; adds ``errors`` and ``result_count`` (0 where a search omits it)."""
    kind = F.col("event_type")

    def needed(event_type: str, field: str) -> Column:
        return (kind != event_type) | F.col(f"_p.{field}").isNotNull()

    rules = {
        "product_id": needed("product_view", "product_id"),
        "order_id": needed("purchase", "order_id"),
        "total_amount": needed("purchase", "total_amount"),
        "item_count": needed("purchase", "item_count"),
        "search_query": needed("search", "search_query"),
    }
    count = F.col("_p.result_count").try_cast("bigint")
    return (
        events.withColumn("_p", F.from_json("properties", _TYPED))
        .withColumn("errors", _errors(rules))
        .withColumn("result_count", F.when(kind == "search", F.coalesce(count, F.lit(0))))
        .drop("_p")
    )


def validate_event_batch(events: DataFrame, batch_col: str, low: int = 1, high: int = MAX_BATCH_SIZE) -> DataFrame:
    """Totals per request batch and whether its size is allowed. Needs an ``errors`` column."""
    valid = F.size("errors") == 0
    return (
        events.groupBy(batch_col)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(valid).alias("published"),
            F.count_if(~valid).alias("failed"),
        )
        .withColumn("accepted", F.col("total").between(low, high))
    )


def event_to_row(events: DataFrame, now: Column | None = None) -> DataFrame:
    """The 15 raw columns; properties become real JSON text, missing optional columns become NULL."""
    columns = []
    for field in RAW_USER_EVENTS.fields:
        if field.name == "ingested_at":
            value = F.current_timestamp() if now is None else now
        elif field.name not in events.columns:
            value = F.lit(None)
        elif field.name == "properties" and not isinstance(events.schema["properties"].dataType, StringType):
            value = F.to_json("properties")
        elif field.name == "event_timestamp" and isinstance(events.schema[field.name].dataType, StringType):
            value = F.try_to_timestamp(field.name)
        else:
            value = F.col(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return events.select(*columns)


def list_event_types(spark: SparkSession) -> DataFrame:
    """Catalogue of supported types."""
    return spark.createDataFrame([(t,) for t in EVENT_TYPES], "event_type string")


def event_type_usage(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Every catalogued type and every type seen, with its number of events."""
    seen = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    listed = list_event_types(spark).select("event_type", F.lit(0).cast("bigint").alias("events"))
    return (
        seen.unionByName(listed)
        .groupBy("event_type")
        .agg(F.sum("events").alias("events"))
        .withColumn("supported", F.col("event_type").isin(*EVENT_TYPES))
    )


def event_counters(events: DataFrame, window: str = "1 minute", time_col: str = "event_time") -> DataFrame:
    """Received events per window, type and device."""
    return (
        events.groupBy(F.window(time_col, window).alias("_w"), "event_type", "device_type")
        .agg(F.count(F.lit(1)).alias("received"))
        .select(F.col("_w.start").alias("window_start"), "event_type", "device_type", "received")
    )


def publish_counters(validated: DataFrame, window: str = "1 minute", time_col: str = "event_time") -> DataFrame:
    """Events per window and publish status, from an ``errors`` column."""
    status = F.when(F.size("errors") == 0, "success").otherwise("error")
    return (
        validated.groupBy(F.window(time_col, window).alias("_w"), status.alias("status"))
        .agg(F.count(F.lit(1)).alias("published"))
        .select(F.col("_w.start").alias("window_start"), "status", "published")
    )


def error_rate_alert(
    events: DataFrame,
    is_error: Column,
    window: str = "5 minutes",
    threshold: float = 0.05,
    time_col: str = "event_time",
    watermark: str = "10 minutes",
) -> DataFrame:
    """Windows whose share of errors exceeds the threshold."""
    if events.isStreaming:
        events = timed(events, time_col, watermark)
    counted = (
        events.select(F.col(time_col), flag(is_error).alias("_bad"))
        .groupBy(F.window(time_col, window).alias("_w"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum("_bad").alias("errors"))
    )
    rate = F.col("errors").cast("double") / F.col("events")
    return counted.select(
        F.col("_w.start").alias("window_start"), "events", "errors", rate.alias("error_rate")
    ).filter(F.col("error_rate") > threshold)


def event_route_attributes(events: DataFrame) -> DataFrame:
    """Message headers for routing and filtering, in the array form a Kafka sink takes."""

    def header(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("binary").alias("value"))

    user = F.when(F.col("user_id").isNotNull() & (F.col("user_id") != 0), F.col("user_id").cast("string"))
    headers = F.array(
        header("event_type", F.col("event_type")),
        header("device_type", F.col("device_type")),
        F.when(user.isNotNull(), header("user_id", user)),
    )
    return events.withColumn("headers", F.array_compact(headers))
