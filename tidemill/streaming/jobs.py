"""Streaming jobs built from the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tidemill.functions.exprs import flag, json_scalar, ratio, typed
from tidemill.functions.keyed import first_per_key
from tidemill.operators.changes import cdc_to_row, parse_cdc
from tidemill.operators.collect import enrich_events, parse_events, session_window_agg, timed, untimed
from tidemill.streaming import sinks


def ingest_events(
    messages: DataFrame, events_path: str, dead_path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Parse, enrich and store events and dead letters. See ``_store_both`` for how often a batch is read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        def store(good: DataFrame) -> None:
            rows = sinks.raw_event_rows(enrich_events(good))
            ordered = rows.sortWithinPartitions("event_date", "event_type", "device_type")
            sinks.write_batch(ordered, events_path, batch_id, ("event_date",))

        _store_both(batch, parse_events, store, dead_path, batch_id)

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return sinks._trigger(writer, interval).start()


def _store_both(
    batch: DataFrame,
    parse: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    store: Callable[[DataFrame], None],
    dead_path: str,
    batch_id: int,
) -> None:
    """Store the good messages of a batch, then its dead letters.

    Nothing of the batch is held by executors, however large a backlog it is. The first write counts messages on their way;
    the batch is read once more only if some were dead. A source gives the same rows for the same batch.
    """
    messages, all_seen, good_seen = batch.select("value"), Observation(), Observation()
    count = F.count(F.lit(1)).alias("n")
    store(parse(messages.observe(all_seen, count))[0].observe(good_seen, count))
    dead = parse(messages)[1]
    some = all_seen.get.get("n") != good_seen.get.get("n")
    sinks.sink_dead_letter(dead if some else dead.limit(0), dead_path, batch_id)


def aggregate_sessions(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "60 seconds",
    watermark: str = "10 minutes",
    interval: str | None = None,
) -> StreamingQuery:
    """Session aggregates per fixed window. State holds one row per open (window, session)."""
    events = enrich_events(parse_events(messages)[0])
    return sinks.sink_session_aggs(session_window_agg(events, window, watermark), path, checkpoint, interval)


def store_untimed(messages: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Events whose time is missing, unreadable or ahead of the clock: the part that windowed jobs leave out."""
    events = untimed(enrich_events(parse_events(messages)[0]))
    return sinks.sink_raw_events(events, path, checkpoint, interval)


def cdc_microbatch(
    messages: DataFrame,
    path: str,
    dead_path: str,
    checkpoint: str,
    interval: str | None = "5 seconds",
    date_unit: str = "day",
) -> StreamingQuery:
    """Change messages to raw change tables, one commit per interval.

    The checkpoint takes the place of an in-memory buffer: offsets are recorded before and confirmed after the
    write, so a lost driver repeats the open batch and its output is replaced.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        def store(good: DataFrame) -> None:
            sinks.sink_cdc_fanout(cdc_to_row(good), batch_id, path, date_unit)

        _store_both(batch, parse_cdc, store, dead_path, batch_id)

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return sinks._trigger(writer, interval).start()


def dedup_delivery(
    events: DataFrame, key: str = "event_id", time_col: str = "event_time", watermark: str = "10 minutes"
) -> DataFrame:
    """Drop redelivered events; of a batch the earliest of an id stays. State keeps a key only until the watermark
    passes it; a stream's rows without a usable time are not in the result, see ``store_untimed``."""
    if events.isStreaming:
        return timed(events, time_col, watermark).dropDuplicatesWithinWatermark([key])
    rest = [F.col(c) for c in events.columns if c not in (key, time_col) and _orderable(events.schema[c].dataType)]
    return first_per_key(events, [key], [F.col(time_col), *rest])


def _orderable(kind) -> bool:
    return not isinstance(kind, (MapType, VariantType, StructType, ArrayType))


def trending_search_stream(
    events: DataFrame,
    window: str = "1 hour",
    slide: str = "5 minutes",
    min_count: int = 3,
    time_col: str = "event_time",
    watermark: str = "10 minutes",
    approx: bool = False,
) -> DataFrame:
    """Search terms per sliding window.

    Users are counted exactly by two aggregations in a row: one row per window, term and user, then one per window and
    term. A stream keeps state for every user of an open window then; ``approx`` keeps one sketch per window and term.
    """
    if events.isStreaming:
        events = timed(events, time_col, watermark)
    results = json_scalar(F.col("properties"), "result_count")
    searches = events.filter(F.col("event_type") == "search").select(
        time_col,
        json_scalar(F.col("properties"), "search_query").alias("search_query"),
        typed(results, "bigint").alias("results"),
        flag(results == "0").alias("empty"),
        "user_id",
    )
    sums = {
        "search_count": F.count(F.lit(1)),
        "_sum": F.sum("results"),
        "_n": F.count("results"),
        "zero_result_count": F.sum("empty"),
    }
    keys = [F.window(time_col, window, slide).alias("_w"), F.col("search_query")]
    if approx:
        users = F.approx_count_distinct("user_id")
        totals = searches.groupBy(*keys).agg(users.alias("unique_searchers"), *[c.alias(n) for n, c in sums.items()])
    else:
        per_user = searches.groupBy(*keys, "user_id").agg(*[c.alias(n) for n, c in sums.items()])
        totals = per_user.groupBy("_w", "search_query").agg(
            F.count("user_id").alias("unique_searchers"), *[F.sum(n).alias(n) for n in sums]
        )
    return totals.filter(F.col("search_count") >= min_count).select(
        F.col("_w.start").alias("window_start"),
        "search_query",
        "search_count",
        "unique_searchers",
        ratio(F.col("_sum"), F.col("_n")).alias("avg_result_count"),
        "zero_result_count",
    )
