"""Registered queries of streams, sinks and layered tables.

Streams read the given tables as file streams and run until everything available is processed. Tables go to a
fresh folder under the shared folder of the cluster.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import checks, collect, engagement, payments
from tidemill.plans import daily
from tidemill.plans.collect_queries import _EN, _JS
from tidemill.plans.lake import Lake
from tidemill.plans.pay_queries import _RETENTION_SQL, _REVENUE_SQL
from tidemill.plans.pay_queries import staged as staged_pay
from tidemill.plans.quality_queries import _ALL_SQL, _FRESH_SQL, _all_checks, _freshness
from tidemill.plans.query import Query
from tidemill.plans.shop_queries import _EVENT_COLS, _SALES_TYPES, _staged, sales_sql
from tidemill.session import settings, shared_folder
from tidemill.sources import driver_tables as t
from tidemill.sources.tables import source_events_file, source_table
from tidemill.streaming import jobs, ledger, sinks, sources

_D = "CAST(event_timestamp AS DATE)"
TABLES = ("orders", "products", "order_items", "users")


def _finish(query) -> None:
    query.awaitTermination()


def _lake(spark: SparkSession, purpose: str) -> Lake:
    # the given orders span years with few rows a day, so folders per month fit them
    return Lake(spark, shared_folder(spark, purpose), date_unit="month")


def _session_messages(spark, sf):
    """Messages with missing and broken times, in three slices in order of time; the stream runs to the end of each."""
    root = shared_folder(spark, "session-messages")
    messages = t.raw_messages(spark, sf)
    stamp = F.coalesce(
        F.to_date(F.try_to_timestamp(F.get_json_object("value", "$.event_timestamp"))), F.lit("2024-01-01").cast("date")
    )
    slices = F.greatest(F.lit(0), F.least(F.lit(2), F.floor(F.datediff(stamp, F.lit("2024-01-01").cast("date")) / 10)))
    # one pass: every task writes its rows of each slice
    messages.withColumn("part", slices.cast("int")).write.partitionBy("part").text(f"{root}/dealt")
    arrived, fs = sinks.filesystem(spark, f"{root}/in")
    fs.mkdirs(arrived)
    for i in range(3):
        dealt, _ = sinks.filesystem(spark, f"{root}/dealt/part={i}")
        if fs.exists(dealt):
            fs.rename(dealt, arrived.suffix(f"/part={i}"))
        else:
            spark.createDataFrame([], "value string").write.text(f"{root}/in/part={i}")
        lines = spark.readStream.schema("value string").text(f"{root}/in/*/*.txt")
        _finish(jobs.aggregate_sessions(lines, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out").withColumn("event_types", F.concat_ws(",", "event_types"))


def _run_stream(df: DataFrame, purpose: str) -> DataFrame:
    """Run a streaming frame to its end into a table and read it back."""
    spark = df.sparkSession
    root = shared_folder(spark, purpose)
    _finish(sinks.sink_session_aggs(df, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{root}/out")


# A packed file is read by one task, so it holds about as many messages as a split of plain text would; small splits keep
# such files from being put together into one task, which would sort them all at once.
_MESSAGES_PER_FILE = 400_000
_PACKED_SPLITS = {"spark.sql.files.maxPartitionBytes": "16m"}


def _store_messages(messages: DataFrame, folder: str) -> None:
    """Messages as files of one message per line, packed: each repeats the names of its members."""
    messages.write.option("compression", "gzip").option("maxRecordsPerFile", _MESSAGES_PER_FILE).text(folder)


def _event_stream(spark, sf) -> DataFrame:
    return collect.enrich_events(t.user_events_of(t.stream_of(spark, sf, "events")))


def _message_files(spark, sf) -> str:
    folder = shared_folder(spark, "messages") + "/files"
    t.raw_messages(spark, sf).write.text(folder)
    return folder


# ---- sources


def _source_events_stream(spark, sf):
    root = shared_folder(spark, "events")
    messages = sources.source_events_stream(spark, _message_files(spark, sf), "text")
    _finish(jobs.ingest_events(messages, f"{root}/events", f"{root}/dead", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/events").select(
        "event_id", "event_type", "event_timestamp", "user_id", "session_id", "device_type", "page_url"
    )


def _sink_dead_letter(spark, sf):
    root = shared_folder(spark, "dead")
    messages = t.raw_messages_of(t.stream_of(spark, sf, "events"))
    _finish(jobs.ingest_events(messages, f"{root}/events", f"{root}/dead", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/dead").select("raw_data", F.col("error_timestamp").isNotNull().alias("stamped"))


def _change_rows(df):
    return df.select(
        "cdc_table", "cdc_operation", "cdc_timestamp",
        F.col("before_data").isNotNull().alias("has_before"), F.col("after_data").isNotNull().alias("has_after"),
    )


def _source_cdc_stream(spark, sf):
    root = shared_folder(spark, "cdc")
    _store_messages(reduce(DataFrame.unionByName, [t.change_messages(spark, sf, n) for n in TABLES]), f"{root}/files")
    messages = sources.source_cdc_stream(spark, f"{root}/files", "text")
    with settings(spark, _PACKED_SPLITS):
        run = jobs.cdc_microbatch(messages, f"{root}/out", f"{root}/dead", f"{root}/checkpoint", interval=None, date_unit="month")
    _finish(run)
    return _change_rows(spark.read.parquet(f"{root}/out"))


def _cdc_microbatch(spark, sf):
    root = shared_folder(spark, "cdc")
    streams = [t.change_messages_of(t.stream_of(spark, sf, t.CHANGES[n][0]), n) for n in TABLES]
    messages = reduce(DataFrame.unionByName, streams)
    _finish(jobs.cdc_microbatch(messages, f"{root}/out", f"{root}/dead", f"{root}/checkpoint", interval=None, date_unit="month"))
    return _change_rows(spark.read.parquet(f"{root}/out"))


_CHANGE_ROWS = """SELECT cdc_table, cdc_operation, cdc_timestamp, before_data IS NOT NULL AS has_before,
    after_data IS NOT NULL AS has_after FROM """


def _topic_route(spark, sf):
    """Change messages under the connector's topic of the table each of them names, and event messages, which keep theirs."""
    table = F.get_json_object("value", "$.source.table")
    logs = reduce(DataFrame.unionByName, [t.change_messages(spark, sf, n) for n in TABLES])
    messages = logs.withColumn("topic", F.concat(F.lit("cdc.ecommerce.public."), table)).unionByName(
        t.raw_messages(spark, sf).select("value", F.lit("events.raw").alias("topic"))
    )
    routed = sources.cdc_topic_route(messages).select("topic", table.alias("table_name"), F.octet_length("value").alias("n"))
    return routed.groupBy("topic", "table_name").agg(F.count(F.lit(1)).alias("messages"), F.sum("n").alias("message_bytes"))


def _events_file(spark, sf):
    folder = shared_folder(spark, "files") + "/events"
    t.user_events(spark, sf).drop("ingested_at").write.json(folder)
    return source_events_file(spark, folder).select("event_id", "event_type", "user_id", "session_id", "page_url")


# ---- sinks and streaming operators


def _sink_raw_events(spark, sf):
    root = shared_folder(spark, "raw")
    _finish(sinks.sink_raw_events(_event_stream(spark, sf), f"{root}/events", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/events").select(
        "event_id", "event_type", "event_timestamp", "event_date", "event_hour", "user_id", "session_id",
        "device_type", "page_url", "properties", "ingested_at",
    )


def _fanout(spark, sf):
    rows = reduce(DataFrame.unionByName, [t.changes(spark, sf, n) for n in TABLES])
    return sinks.sink_cdc_fanout(rows, 0, shared_folder(spark, "fanout") + "/cdc", date_unit="month")


_CLOSED = "(SELECT max(event_timestamp) - INTERVAL 10 MINUTE FROM user_events)"


def _error_stream(spark, sf):
    events = _event_stream(spark, sf)
    return _run_stream(
        collect.error_rate_alert(events, F.col("event_type") == "remove_from_cart", "5 minutes", 0.03), "errors"
    )


# ---- layered tables


def _ctas(spark, sf):
    rows = _staged(spark, sf).withColumn("event_date", F.to_date("event_timestamp"))
    return _lake(spark, "ctas").ctas_replace(rows, "staging", "events_by_day", "event_date", ("event_type", "user_id"))


def _partition_overwrite(spark, sf):
    lake = _lake(spark, "overwrite")
    rows = t.user_events_once(spark, sf).select("event_id", F.to_date("event_timestamp").alias("d"))
    first = rows.withColumn("version", F.lit("first"))
    lake.ctas_replace(first, "raw", "versions", "d")
    lake.partition_overwrite(
        rows.filter(F.col("d") == F.lit("2024-01-30").cast("date")).withColumn("version", F.lit("second")),
        "raw", "versions", "d",
    )
    return lake.read("raw", "versions").groupBy("d", "version").agg(F.count(F.lit(1)).alias("n"))


def _run_query(spark, sf):
    lake = _lake(spark, "query")
    t.orders(spark, sf).createOrReplaceTempView("tidemill_orders")
    statement = """SELECT delivery_type, count(*) AS orders FROM tidemill_orders
        WHERE order_status = :status GROUP BY delivery_type"""
    lake.run_query_to_table(statement, "mart", "by_delivery", {"status": "DELIVERED"})
    lake.run_query_to_table(statement, "mart", "by_delivery", {"status": "SHIPPING"}, "append")
    return lake.read("mart", "by_delivery")


def _bootstrap(spark, sf):
    lake = _lake(spark, "layers")
    created = lake.bootstrap_layers()
    lake.store(t.orders(spark, sf).select("*", *_missing_order_columns()), "staging", "orders")
    filled = lake.read("staging", "orders").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("staging").alias("layer"), F.lit("orders").alias("table_name"), "n"
    )
    again = lake.bootstrap_layers().select("layer", "table_name", F.lit(-1).cast("bigint").alias("n"))
    empty = created.select("layer", "table_name", F.lit(0).cast("bigint").alias("n"))
    return empty.unionByName(filled).unionByName(again).groupBy("layer", "table_name").agg(F.sum("n").alias("n"))


def _missing_order_columns():
    names = ("delivered_at", "updated_at", "_cdc_timestamp", "_etl_loaded_at")
    return [F.lit(None).cast("timestamp").alias(n) for n in names]


def _expire(spark, sf):
    lake = _lake(spark, "expire")
    rows = collect.enrich_events(t.user_events_once(spark, sf))
    lake.ctas_replace(sinks.raw_event_rows(rows), "raw", "user_events", "event_date")
    dropped = lake.expire_raw_partitions("user_events", t.EVENTS_AS_OF, days=15, unit="day")
    kept = lake.read("raw", "user_events").groupBy(F.col("event_date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return kept.unionByName(dropped.select(F.col("partition_date").alias("d"), F.lit(0).cast("bigint").alias("n")))


def _freshness_view(spark, sf):
    frame = _freshness(spark, sf)
    return Lake(spark, "").materialize_model(frame, "tidemill_table_freshness", "view")


def _materialize(spark, sf):
    sessions = payments.int_user_sessions(staged_pay(spark, sf))
    lake = _lake(spark, "model")
    inline = lake.materialize_model(sessions, "sessions", "ephemeral")
    funnel = payments.mart_payment_funnel(inline).select("dt", "device_type", "total_sessions")
    return lake.materialize_model(funnel, "payment_funnel", "table", "dt")


def _sink_quality(spark, sf):
    lake = _lake(spark, "quality")
    lake.sink_quality_results(_all_checks(spark, sf))
    return lake.read("monitoring", "data_quality_checks").drop("checked_date")


def _daily(spark, sf):
    lake = _lake(spark, "daily")
    log = daily.run_batch(
        lake, *[t.changes(spark, sf, n) for n in TABLES], t.user_events(spark, sf)
    )
    return lake, log


def _run_batch(spark, sf):
    lake, _ = _daily(spark, sf)
    return lake.read("mart", "daily_sales")


def _run_batch_twice(spark, sf):
    """The daily job over the changes up to a date, then once more with only what came after it."""
    lake = _lake(spark, "daily-since")
    cut = F.lit("1996-01-01").cast("timestamp")
    logs = [t.changes(spark, sf, n) for n in TABLES]
    events, later = t.user_events(spark, sf), F.col("ingested_at") >= F.lit("2024-01-20").cast("timestamp")
    after = F.col("cdc_timestamp") >= cut
    daily.run_batch(lake, *[log.filter(~after) for log in logs], events.filter(~later))
    daily.run_batch_since(lake, *[log.filter(after) for log in logs], events.filter(later))
    return lake.read("mart", "daily_sales")


def _run_batch_streams(spark, sf):
    """Streams store the messages up to a date, the daily job takes them, then both go on with the rest."""
    lake = _lake(spark, "daily-streams")
    changes = ledger.change_table(*[f"{lake.root}/changes/{n}" for n in ("rows", "checkpoint", "ledger")])
    events = ledger.event_table(*[f"{lake.root}/events/{n}" for n in ("rows", "checkpoint", "ledger")])
    log = reduce(DataFrame.unionByName, [t.change_messages(spark, sf, n) for n in TABLES])
    # 1996-01-01, in the milliseconds of the envelopes
    changed = F.coalesce(F.get_json_object("value", "$.ts_ms").cast("bigint") >= 820454400000, F.lit(False))
    seen = F.coalesce(F.get_json_object("value", "$.event_timestamp") >= "2024-01-20", F.lit(False))
    for i in range(2):
        for messages, later, name in ((log, changed, "changes"), (t.raw_messages(spark, sf), seen, "events")):
            _store_messages(messages.filter(later if i else ~later), f"{lake.root}/{name}/in/part={i}")
        source = sources.source_cdc_stream(spark, f"{lake.root}/changes/in/*", "text")
        dead = f"{lake.root}/changes/dead"
        with settings(spark, _PACKED_SPLITS):
            run = jobs.cdc_microbatch(source, changes.path, dead, changes.checkpoint, interval=None, date_unit="month")
        _finish(run)
        source = sources.source_events_stream(spark, f"{lake.root}/events/in/*", "text")
        with settings(spark, _PACKED_SPLITS):
            run = jobs.ingest_events(source, events.path, f"{lake.root}/events/dead", events.checkpoint)
        _finish(run)
        for name in ("changes", "events"):  # both streams have confirmed these messages
            arrived, fs = sinks.filesystem(spark, f"{lake.root}/{name}/in/part={i}")
            fs.delete(arrived, True)
        daily.run_batch_from_streams(lake, changes, events)
    return lake.read("mart", "daily_sales")


def _run_metrics(spark, sf):
    _, log = _daily(spark, sf)
    return checks.run_counters(log.frame()).drop("duration_sec")


def _payment_metrics(spark, sf):
    lake = _lake(spark, "payment")
    daily.run_payment_metrics(lake, t.pay_events(spark, sf), t.EVENTS_AS_OF, gate=False)
    return lake.read("mart", "mart_revenue").select("dt", "paying_users", "net_revenue")


def _retention_by_day(spark, sf):
    """Retention from login days that two daily runs have stored, the second over a day of the first once more."""
    lake = _lake(spark, "login-days")
    staged, at = staged_pay(spark, sf), F.col("event_timestamp")
    daily.update_login_days(lake, staged.filter(at < "2024-01-16"))
    daily.update_login_days(lake, staged.filter(at >= "2024-01-15"))
    return engagement.retention_of_login_days(lake.read("staging", "login_days"), t.EVENTS_AS_OF)


def _sla(spark, sf):
    """A daily run that succeeds and a payment run that its quality gate stops: the given transactions break a P0 rule."""
    lake, _ = _daily(spark, sf)
    try:
        daily.run_payment_metrics(lake, t.pay_events(spark, sf), t.EVENTS_AS_OF)
    except daily.QualityGateFailure:
        pass
    return checks.sla_alerts(checks.run_counters(lake.read("monitoring", "run_log")), _freshness(spark, sf))


_JS_OK = """SELECT event_id, kind AS event_type, ts AS event_timestamp, user_id, session_id, device_type, page_url FROM en"""


def _en(body: str) -> str:
    return f"WITH {_EN} {body}"


def _js(body: str) -> str:
    return f"WITH {_JS} {body}"


_STATE = {
    "o": "json_extract_string(after_data, '$.order_id')",
    "p": "json_extract_string(after_data, '$.product_id')",
    "i": "json_extract_string(after_data, '$.item_id')",
}


def _latest(table: str, key: str) -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY cdc_timestamp DESC,
        ingested_at DESC, after_data DESC) AS rn FROM cdc_{table} WHERE cdc_operation <> 'DELETE') WHERE rn = 1)"""


def _j(alias: str, member: str, kind: str = "VARCHAR") -> str:
    return f"CAST(json_extract_string({alias}.after_data, '$.{member}') AS {kind})"


_BATCH_SQL = f"""WITH o AS (SELECT {_j("x", "order_id", "BIGINT")} AS order_id, {_j("x", "user_id", "BIGINT")} AS user_id,
        {_j("x", "order_status")} AS order_status, {_j("x", "total_amount", "DOUBLE")} AS total_amount,
        {_j("x", "delivery_type")} AS delivery_type,
        CAST(replace(replace({_j("x", "ordered_at")}, 'T', ' '), 'Z', '') AS TIMESTAMP) AS ordered_at
        FROM {_latest("orders", _STATE["o"])} AS x),
    p AS (SELECT {_j("x", "product_id", "BIGINT")} AS product_id, {_j("x", "category_l1")} AS category_l1,
        {_j("x", "storage_type")} AS storage_type FROM {_latest("products", _STATE["p"])} AS x),
    i AS (SELECT {_j("x", "order_id", "BIGINT")} AS order_id, {_j("x", "product_id", "BIGINT")} AS product_id,
        {_j("x", "quantity", "BIGINT")} AS quantity FROM {_latest("order_items", _STATE["i"])} AS x),
    """ + sales_sql("o", "i", "p")

_RUN_SQL = f"""SELECT 'daily_batch' AS pipeline_name, 'success' AS status, 7 AS runs, 0 AS errors,
    (SELECT count(*) FROM {_latest("orders", _STATE["o"])}) + (SELECT count(*) FROM {_latest("products", _STATE["p"])})
    + (SELECT count(*) FROM {_latest("order_items", _STATE["i"])})
    + (SELECT count(*) FROM {_latest("users", "json_extract_string(after_data, '$.user_id')")})
    + (SELECT count(DISTINCT event_id) FROM user_events) + (SELECT count(*) FROM ({_BATCH_SQL}))
    + (SELECT count(*) FROM (SELECT DISTINCT {_D}, device_type FROM user_events_once)) AS rows_processed"""

QUERIES = [
    Query("source_events_stream", _source_events_stream, _en(_JS_OK)),
    Query("source_cdc_stream", _source_cdc_stream, " UNION ALL ".join(_CHANGE_ROWS + f"cdc_{n}" for n in TABLES)),
    Query(
        "cdc_topic_route",
        _topic_route,
        " UNION ALL ".join(
            f"SELECT {topic} AS topic, {table} AS table_name, count(*) AS messages, sum(strlen(value)) AS message_bytes FROM {source}"
            for topic, table, source in [
                *[(f"'cdc.{n}'", f"'{n}'", f"msg_{n}") for n in TABLES],
                ("'events.raw'", "CAST(NULL AS VARCHAR)", "raw_messages"),
            ]
        ),
        ints="message_bytes",
    ),
    Query(
        "source_table",
        lambda sp, sf: source_table(sp, _stored(sp, sf).root, "staging", "orders").select("order_id", "order_status"),
        "SELECT order_id, order_status FROM s_orders",
    ),
    Query(
        "source_events_file",
        _events_file,
        "SELECT event_id, event_type, user_id, session_id, page_url FROM user_events",
        ints="user_id",
    ),
    Query(
        "sink_raw_events",
        _sink_raw_events,
        f"""SELECT event_id, event_type, event_timestamp, {_D} AS event_date, hour(event_timestamp) AS event_hour, user_id,
        session_id, device_type, page_url, properties, ingested_at FROM user_events""",
        ints="user_id event_hour",
    ),
    Query(
        "sink_session_aggs",
        lambda sp, sf: _run_stream(collect.session_window_agg(_event_stream(sp, sf)), "sessions").withColumn(
            "event_types", F.concat_ws(",", "event_types")
        ),
        f"""SELECT session_id, count(*) AS event_count, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS event_types,
        arg_min_null(user_id, (event_timestamp, event_id)) AS user_id,
        arg_min_null(device_type, (event_timestamp, event_id)) AS device_type,
        min(event_timestamp) AS first_event_at, max(event_timestamp) AS last_event_at,
        bool_or(event_type = 'purchase') AS has_purchase, date_trunc('minute', event_timestamp) AS window_start
        FROM user_events GROUP BY session_id, date_trunc('minute', event_timestamp)
        HAVING date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE <= {_CLOSED}""",
        ints="user_id",
    ),
    Query(
        "session_windows_messages",
        _session_messages,
        _en("""SELECT session_id, count(*) AS event_count,
        array_to_string(list_sort(list(DISTINCT kind)), ',') AS event_types, arg_min_null(user_id, (ts, event_id)) AS user_id,
        arg_min_null(device_type, (ts, event_id)) AS device_type, min(ts) AS first_event_at, max(ts) AS last_event_at,
        bool_or(kind = 'purchase') AS has_purchase, date_trunc('minute', ts) AS window_start
        FROM en WHERE ts IS NOT NULL GROUP BY session_id, date_trunc('minute', ts)
        HAVING date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM en)"""),
        ints="user_id",
    ),
    Query(
        "sink_dead_letter",
        _sink_dead_letter,
        _js("""SELECT value AS raw_data, true AS stamped FROM jk
        WHERE event_id IS NULL OR event_type IS NULL OR session_id IS NULL"""),
    ),
    Query(
        "sink_cdc_fanout",
        _fanout,
        " UNION ALL ".join(f"SELECT '{n}' AS cdc_table, count(*) AS rows_written FROM v_{n}" for n in TABLES),
    ),
    Query("cdc_microbatch", _cdc_microbatch, " UNION ALL ".join(_CHANGE_ROWS + f"cdc_{n}" for n in TABLES)),
    Query(
        "dedup_delivery",
        lambda sp, sf: _run_stream(
            jobs.dedup_delivery(_event_stream(sp, sf)).select("event_id", "event_type", "session_id"), "dedup"
        ),
        "SELECT event_id, event_type, session_id FROM user_events_once",
    ),
    Query(
        "error_rate_stream",
        _error_stream,
        f"""SELECT *, CAST(errors AS DOUBLE) / events AS error_rate FROM (
        SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start, count(*) AS events,
        count(*) FILTER (WHERE event_type = 'remove_from_cart') AS errors FROM user_events GROUP BY 1)
        WHERE CAST(errors AS DOUBLE) / events > 0.03 AND window_start + INTERVAL 5 MINUTE <= {_CLOSED}""",
        "error_rate",
    ),
    Query(
        "trending_search_stream",
        lambda sp, sf: _run_stream(jobs.trending_search_stream(_event_stream(sp, sf), min_count=1), "trending"),
        f"""WITH s AS (SELECT user_id, json_extract_string(properties, '$.search_query') AS search_query,
            json_extract_string(properties, '$.result_count') AS rc,
            unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, event_timestamp) - INTERVAL 55 MINUTE,
                time_bucket(INTERVAL 5 MINUTE, event_timestamp), INTERVAL 5 MINUTE)) AS window_start
            FROM user_events WHERE event_type = 'search')
        SELECT window_start, search_query, count(*) AS search_count, count(DISTINCT user_id) AS unique_searchers, avg(CAST(rc AS BIGINT)) AS avg_result_count,
            count(*) FILTER (WHERE rc = '0') AS zero_result_count FROM s
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(event_timestamp) - INTERVAL 10 MINUTE FROM user_events
            WHERE event_type = 'search') GROUP BY 1, 2""",
        "avg_result_count",
    ),
    Query(
        "ctas_replace",
        _ctas,
        f"""SELECT *, {_D} AS event_date FROM (SELECT {_EVENT_COLS} FROM (SELECT *,
        row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS rn FROM user_events) WHERE rn = 1)""",
        ints="user_id",
    ),
    Query(
        "partition_overwrite",
        _partition_overwrite,
        f"""SELECT {_D} AS d, CASE WHEN {_D} = DATE '2024-01-30' THEN 'second' ELSE 'first' END AS version, count(*) AS n
        FROM user_events_once GROUP BY 1, 2""",
    ),
    Query(
        "run_query_to_table",
        _run_query,
        """SELECT delivery_type, count(*) AS orders FROM s_orders WHERE order_status IN ('DELIVERED', 'SHIPPING')
        GROUP BY order_status, delivery_type""",
    ),
    Query(
        "bootstrap_layers",
        _bootstrap,
        """SELECT layer, table_name, CASE WHEN table_name = 'orders' THEN (SELECT count(*) FROM s_orders) ELSE 0 END AS n
        FROM (VALUES ('raw', 'user_events'), ('raw', 'session_aggregations'), ('raw', 'dead_letter_events'),
            ('raw', 'cdc_users'), ('raw', 'cdc_products'), ('raw', 'cdc_orders'), ('raw', 'cdc_order_items'),
            ('staging', 'orders'), ('staging', 'products'), ('staging', 'order_items'), ('staging', 'users'),
            ('staging', 'user_events'), ('staging', 'login_days'), ('mart', 'daily_sales'), ('mart', 'daily_funnel'),
            ('monitoring', 'data_quality_checks')) v(layer, table_name)""",
    ),
    Query(
        "expire_raw_partitions",
        _expire,
        f"""SELECT {_D} AS d, CASE WHEN {_D} < DATE '2024-01-31' - 15 THEN 0 ELSE count(*) END AS n
        FROM user_events_once GROUP BY 1""",
    ),
    Query("view_table_freshness", _freshness_view, _FRESH_SQL),
    Query(
        "materialize_model",
        _materialize,
        """SELECT CAST(session_start AS DATE) AS dt, device_type, count(DISTINCT session_id) AS total_sessions
        FROM int_user_sessions WHERE has_payment_view = 1 GROUP BY 1, 2""",
    ),
    Query("sink_quality_results", _sink_quality, _ALL_SQL, "metric_value"),
    Query("daily_batch", _run_batch, _BATCH_SQL, **_SALES_TYPES),
    Query("daily_batch_streams", _run_batch_streams, _BATCH_SQL, **_SALES_TYPES),
    Query("daily_batch_since", _run_batch_twice, _BATCH_SQL, **_SALES_TYPES),
    Query(
        "payment_metrics",
        _payment_metrics,
        f"SELECT dt, paying_users, net_revenue FROM ({_REVENUE_SQL})",
        ints="net_revenue",
    ),
    Query("retention_by_day", _retention_by_day, _RETENTION_SQL, "retention_rate"),
    Query("run_metrics", _run_metrics, _RUN_SQL, ints="runs errors rows_processed"),
    Query(
        "sla_alerts",
        _sla,
        f"""SELECT 'DataFreshnessSLABreach' AS alert, 'critical' AS severity, table_name AS subject,
        CAST(freshness_minutes AS DOUBLE) AS value FROM ({_FRESH_SQL}) WHERE freshness_minutes > 30
        UNION ALL SELECT 'PipelineExecutionFailed', 'warning', 'payment_metrics', 1 WHERE EXISTS (SELECT transaction_id
        FROM stg_transactions GROUP BY transaction_id HAVING count(*) > 1 AND transaction_id IS NOT NULL)""",
        "value",
    ),
]


def _stored(spark, sf) -> Lake:
    lake = _lake(spark, "stored")
    lake.store(t.orders(spark, sf).select("*", *_missing_order_columns()), "staging", "orders")
    return lake
