"""Registered queries of event collection and change capture, over message text built from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exprs import moment
from tidemill.operators import changes as c
from tidemill.operators import collect as k
from tidemill.operators import taxonomy as x
from tidemill.plans.query import Query
from tidemill.sources import driver_tables as t

NOW = t.EVENTS_AS_OF_TS


def parsed(spark, sf):
    return k.parse_events(t.raw_messages(spark, sf))[0]


def enriched(spark, sf):
    return k.enrich_events(parsed(spark, sf), now=moment(NOW))


def _member(name: str):
    return F.get_json_object("properties", f"$.{name}")


_JS = """js AS (SELECT value, CASE WHEN json_valid(value) THEN CASE WHEN json_type(value) = 'OBJECT' THEN value END END AS j
    FROM raw_messages),
    jk AS (SELECT *, json_extract_string(j, '$.event_id') AS event_id, json_extract_string(j, '$.event_type') AS event_type,
        json_extract_string(j, '$.session_id') AS session_id FROM js),
    ok AS (SELECT *, CAST(json_extract_string(j, '$.user_id') AS BIGINT) AS user_id,
        json_extract_string(j, '$.device_type') AS device_type, json_extract_string(j, '$.page_url') AS page_url,
        json_extract_string(j, '$.event_timestamp') AS stamp,
        TRY_CAST(replace(replace(json_extract_string(j, '$.event_timestamp'), 'T', ' '), 'Z', '') AS TIMESTAMP) AS ts,
        json_extract(j, '$.properties') AS properties FROM jk
        WHERE event_id IS NOT NULL AND event_type IS NOT NULL AND session_id IS NOT NULL)"""
_EN = f"""{_JS}, en AS (SELECT *, lower(event_type) AS kind, coalesce(ts, TIMESTAMP '{NOW}') AS event_time FROM ok)"""
_TYPES = ", ".join(f"'{e}'" for e in k.EVENT_TYPES)
_DEVICES = ", ".join(f"'{d}'" for d in k.DEVICE_TYPES)
_ERRORS = f"""concat_ws(',', CASE WHEN NOT coalesce(length(event_id) >= 8, false) THEN 'event_id' END,
    CASE WHEN NOT coalesce(kind IN ({_TYPES}), false) THEN 'event_type' END,
    CASE WHEN NOT coalesce(device_type IN ({_DEVICES}), false) THEN 'device_type' END)"""


def _missing(kind: str, member: str) -> str:
    return (
        f"CASE WHEN kind = '{kind}' AND json_extract_string(properties, '$.{member}') IS NULL THEN '{member}' END"
    )


_TYPED_ERRORS = (
    f"concat_ws(',', {_missing('product_view', 'product_id')}, {_missing('purchase', 'order_id')}, "
    f"{_missing('purchase', 'total_amount')}, {_missing('purchase', 'item_count')}, {_missing('search', 'search_query')})"
)


def _joined_errors(df):
    return df.withColumn("errors", F.concat_ws(",", "errors"))


def _headers(spark, sf):
    routed = k.event_route_attributes(enriched(spark, sf))
    pairs = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string")))
    return routed.select("event_id", F.concat_ws(";", pairs).alias("headers"))




def _pay_errors_sql() -> str:
    def get(key: str) -> str:
        return f"CASE json_type(value, '$.{key}') WHEN 'VARCHAR' THEN json_extract_string(value, '$.{key}') END"

    def typed(key: str, *kinds: str) -> str:
        return f"coalesce(json_type(value, '$.{key}'), 'NULL') IN ('NULL', {', '.join(repr(k) for k in kinds)})"

    tests = {r: f"length({get(r)}) >= 1" for r in x.REQUIRED}
    tests["event_name"] = f"regexp_matches({get('event_name')}, '^[a-z_]+\\.[a-z_]+\\.[a-z_]+$')"
    tests["event_timestamp"] = f"TRY_CAST({get('event_timestamp')} AS TIMESTAMP) IS NOT NULL"
    tests["device_type"] = f"{get('device_type')} IN ('ios', 'android', 'web')"
    tests["app_version"] = f"regexp_matches({get('app_version')}, '^\\d+\\.\\d+\\.\\d+$')"
    for name in ("os_version", "screen_name"):
        tests[name] = typed(name, "VARCHAR")
    tests["properties"] = "coalesce(json_type(value, '$.properties'), 'OBJECT') = 'OBJECT'"
    for name in x.TEXT_PROPERTIES:
        tests[name] = typed(f"properties.{name}", "VARCHAR")
    tests["amount"] = typed("properties.amount", "UBIGINT")
    method = get("properties.payment_method")
    tests["payment_method"] = f"json_type(value, '$.properties.payment_method') IS NULL OR {method} IN ('card', 'bank_transfer', 'app_balance')"
    tests["is_first_payment"] = typed("properties.is_first_payment", "BOOLEAN")
    allowed = ", ".join(f"'{n}'" for n in (*x.REQUIRED, *x.OPTIONAL))
    tests["unknown_key"] = f"len(list_filter(json_keys(value), lambda y: NOT list_contains([{allowed}], y))) = 0"
    cases = ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{n}' END" for n, ok in tests.items())
    return f"SELECT event_id AS key, concat_ws(',', {cases}) AS errors FROM raw_pay_messages"


LOGS = ("orders", "products", "order_items", "users")


def _cdc(spark, sf, logs=LOGS):
    return c.parse_cdc(reduce(DataFrame.unionByName, [t.change_messages(spark, sf, n) for n in logs]))[0]


_LABEL = "CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' WHEN 'r' THEN 'SNAPSHOT' ELSE 'UNKNOWN' END"
_CDC = """m AS (SELECT json_extract_string(value, '$.source.table') AS table_name, json_extract_string(value, '$.op') AS op,
    CAST(json_extract_string(value, '$.ts_ms') AS BIGINT) AS ts_ms,
    nullif(json_extract(value, '$.before'), 'null') AS b, nullif(json_extract(value, '$.after'), 'null') AS a FROM {messages})"""
_LOGS = "(" + " UNION ALL ".join(f"SELECT value FROM msg_{n}" for n in LOGS) + ")"
_ALL_CDC, _ORDER_CDC = _CDC.format(messages=_LOGS), _CDC.format(messages="msg_orders")

# What an earlier release declared: it knew no delivery type, had a coupon and telephone numbers, and took sums for whole.
EARLIER_FIELDS = {
    "orders": {n: f for n, f in c.ORDER_FIELDS.items() if n != "delivery_type"}
    | {"total_amount": ("total_amount", "bigint"), "coupon_id": ("coupon_id", "string")},
    "products": c.PRODUCT_FIELDS | {"discount_rate": ("discount_rate", "bigint")},
    "order_items": c.ORDER_ITEM_FIELDS | {"product_id": ("product_id", "string")},
    "users": c.USER_FIELDS | {"phone": ("phone", "string")},
}
_DECLARED = ", ".join(f"('{t}', '{m}', '{kind}')" for t, own in EARLIER_FIELDS.items() for m, kind in own.values())
_DRIFT = f"""WITH d AS ({" UNION ALL ".join(f"SELECT cdc_table, CAST(cdc_timestamp AS DATE) AS cdc_date, coalesce(after_data, before_data) AS doc FROM cdc_{n}" for n in LOGS)}),
    f AS (SELECT * FROM (VALUES {_DECLARED}) v(cdc_table, member, declared)),
    k AS (SELECT cdc_table, cdc_date, doc, unnest(json_keys(doc)) AS member FROM d),
    m AS (SELECT cdc_table, cdc_date, member, CASE json_type(doc, '$.' || member) WHEN 'UBIGINT' THEN 'whole' WHEN 'BIGINT' THEN 'whole'
        WHEN 'DOUBLE' THEN 'fraction' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN NULL
        ELSE 'nested' END AS kind FROM k),
    s AS (SELECT cdc_table, cdc_date, member, declared, count(*) AS filled, string_agg(DISTINCT kind, ',' ORDER BY kind) AS found_kinds,
        count(*) FILTER (WHERE NOT CASE declared WHEN 'bigint' THEN kind = 'whole' WHEN 'double' THEN kind IN ('whole', 'fraction')
            WHEN 'boolean' THEN kind = 'boolean' ELSE kind = 'text' END) AS odd
        FROM m LEFT JOIN f USING (cdc_table, member) GROUP BY ALL)
    SELECT cdc_table, cdc_date, member, CASE WHEN declared IS NULL THEN 'new' ELSE 'retyped' END AS problem, declared, found_kinds, filled
        FROM s WHERE declared IS NULL OR odd > 0
    UNION ALL SELECT cdc_table, cdc_date, member, 'missing', declared, NULL, 0
        FROM (SELECT DISTINCT cdc_table, cdc_date FROM d) JOIN f USING (cdc_table)
        ANTI JOIN s USING (cdc_table, cdc_date, member)"""

QUERIES = [
    Query(
        "parse_events",
        lambda sp, sf: parsed(sp, sf).select(
            "event_id", "event_type", "event_timestamp", "user_id", "session_id", "device_type", "page_url",
            _member("product_id").alias("product_id"), _member("search_query").alias("search_query"),
        ),
        f"""WITH {_JS} SELECT event_id, event_type, stamp AS event_timestamp, user_id, session_id, device_type, page_url,
        json_extract_string(properties, '$.product_id') AS product_id,
        json_extract_string(properties, '$.search_query') AS search_query FROM ok""",
    ),
    Query(
        "without_key",
        lambda sp, sf: c.without_key(
            reduce(DataFrame.unionByName, [t.changes(sp, sf, n) for n in LOGS]), "product_id"
        ).select("cdc_table", "cdc_operation", "cdc_timestamp", "raw_payload"),
        " UNION ALL ".join(
            f"""SELECT cdc_table, cdc_operation, cdc_timestamp, raw_payload FROM cdc_{n} WHERE
            json_extract_string(after_data, '$.product_id') IS NULL AND json_extract_string(before_data, '$.product_id') IS NULL"""
            for n in LOGS
        ),
    ),
    Query(
        "document_drift",
        lambda sp, sf: c.document_drift(
            reduce(DataFrame.unionByName, [t.changes(sp, sf, n) for n in LOGS]), EARLIER_FIELDS
        ),
        _DRIFT,
    ),
    Query(
        "parse_counters",
        lambda sp, sf: k.parse_counters(t.raw_messages(sp, sf)),
        f"""WITH {_JS} SELECT (SELECT count(*) FROM ok) AS parsed_ok,
        (SELECT count(*) FROM js) - (SELECT count(*) FROM ok) AS parse_errors""",
    ),
    Query(
        "dlq_policy",
        lambda sp, sf: k.parse_events(t.raw_messages(sp, sf))[1].select(F.lit("events").alias("topic"), "raw_data")
        .unionByName(
            c.parse_cdc(t.raw_messages(sp, sf))[1].select(F.lit("cdc").alias("topic"), "raw_data")
        ),
        f"""WITH {_JS} SELECT 'events' AS topic, value AS raw_data FROM jk
        WHERE event_id IS NULL OR event_type IS NULL OR session_id IS NULL
        UNION ALL SELECT 'cdc', value FROM js WHERE j IS NULL""",
    ),
    Query(
        "enrich_events",
        lambda sp, sf: enriched(sp, sf).select(
            "event_id", "event_type", "event_timestamp", "event_time", "event_date", "event_hour", "pipeline_version"
        ),
        f"""WITH {_EN} SELECT event_id, kind AS event_type, ts AS event_timestamp, event_time,
        CAST(event_time AS DATE) AS event_date, hour(event_time) AS event_hour, '1.0.0' AS pipeline_version FROM en""",
        ints="event_hour",
    ),
    Query(
        "session_window_agg",
        lambda sp, sf: k.session_window_agg(enriched(sp, sf)).withColumn(
            "event_types", F.concat_ws(",", "event_types")
        ),
        f"""WITH {_EN} SELECT session_id, count(*) AS event_count, array_to_string(list_sort(list(DISTINCT kind)), ',') AS event_types,
        arg_min_null(user_id, (event_time, event_id)) AS user_id, arg_min_null(device_type, (event_time, event_id)) AS device_type,
        min(event_time) AS first_event_at, max(event_time) AS last_event_at, bool_or(kind = 'purchase') AS has_purchase,
        date_trunc('minute', event_time) AS window_start FROM en GROUP BY session_id, date_trunc('minute', event_time)""",
    ),
    Query(
        "validate_events",
        lambda sp, sf: _joined_errors(k.validate_events(enriched(sp, sf))).select("event_id", "session_id", "errors"),
        f"WITH {_EN} SELECT event_id, session_id, {_ERRORS} AS errors FROM en",
    ),
    Query(
        "validate_typed_events",
        lambda sp, sf: _joined_errors(k.validate_typed_events(enriched(sp, sf))).select(
            "event_id", "session_id", "errors", "result_count"
        ),
        f"""WITH {_EN} SELECT event_id, session_id, {_TYPED_ERRORS} AS errors, CASE WHEN kind = 'search' THEN
        coalesce(CAST(json_extract_string(properties, '$.result_count') AS BIGINT), 0) END AS result_count FROM en""",
    ),
    Query(
        "validate_event_batch",
        lambda sp, sf: k.validate_event_batch(k.validate_events(enriched(sp, sf)), "page_url"),
        f"""WITH {_EN}, e AS (SELECT page_url, {_ERRORS} AS errors FROM en) SELECT page_url, count(*) AS total,
        count(*) FILTER (WHERE errors = '') AS published, count(*) FILTER (WHERE errors <> '') AS failed,
        count(*) BETWEEN 1 AND 500 AS accepted FROM e GROUP BY 1""",
    ),
    Query(
        "event_to_row",
        lambda sp, sf: k.event_to_row(parsed(sp, sf), now=moment(NOW)).drop("properties"),
        f"""WITH {_JS} SELECT event_id, event_type, ts AS event_timestamp, user_id, session_id, device_type,
        NULL::VARCHAR AS device_id, NULL::VARCHAR AS app_version, page_url, NULL::VARCHAR AS referrer,
        NULL::VARCHAR AS utm_source, NULL::VARCHAR AS utm_medium, NULL::VARCHAR AS utm_campaign,
        TIMESTAMP '{NOW}' AS ingested_at FROM ok""",
    ),
    Query(
        "list_event_types",
        lambda sp, sf: k.event_type_usage(sp, enriched(sp, sf)),
        f"""WITH {_EN}, l AS (SELECT unnest([{_TYPES}]) AS event_type), n AS (SELECT kind, count(*) AS n FROM en GROUP BY 1)
        SELECT coalesce(l.event_type, n.kind) AS event_type, coalesce(n.n, 0) AS events, l.event_type IS NOT NULL AS supported
        FROM l FULL JOIN n ON l.event_type = n.kind""",
    ),
    Query(
        "event_counters",
        lambda sp, sf: k.event_counters(enriched(sp, sf)),
        f"""WITH {_EN} SELECT date_trunc('minute', event_time) AS window_start, kind AS event_type, device_type,
        count(*) AS received FROM en GROUP BY 1, 2, 3""",
    ),
    Query(
        "publish_counters",
        lambda sp, sf: k.publish_counters(k.validate_events(enriched(sp, sf)), "1 hour"),
        f"""WITH {_EN} SELECT date_trunc('hour', event_time) AS window_start,
        CASE WHEN {_ERRORS} = '' THEN 'success' ELSE 'error' END AS status, count(*) AS published FROM en GROUP BY 1, 2""",
    ),
    Query(
        "error_rate_alert",
        lambda sp, sf: k.error_rate_alert(
            k.validate_events(enriched(sp, sf)), F.size("errors") > 0, "5 minutes", 0.05
        ),
        f"""WITH {_EN}, r AS (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, count(*) AS events,
        count(*) FILTER (WHERE {_ERRORS} <> '') AS errors FROM en GROUP BY 1)
        SELECT *, CAST(errors AS DOUBLE) / events AS error_rate FROM r WHERE CAST(errors AS DOUBLE) / events > 0.05""",
        "error_rate",
    ),
    Query(
        "event_route_attributes",
        _headers,
        f"""WITH {_EN} SELECT event_id, concat_ws(';', 'event_type=' || kind, 'device_type=' || device_type,
        CASE WHEN user_id <> 0 THEN 'user_id=' || user_id END) AS headers FROM en""",
    ),
    Query(
        "validate_event_schema",
        lambda sp, sf: _joined_errors(x.validate_event_schema(t.raw_pay_messages(sp, sf))).drop("value"),
        _pay_errors_sql(),
    ),
    Query(
        "parse_cdc",
        lambda sp, sf: _cdc(sp, sf).select(
            "table_name", "op", "ts_ms",
            F.get_json_object("before", "$.order_status").alias("status_before"),
            F.get_json_object("after", "$.order_status").alias("status_after"),
        ),
        f"""WITH {_ALL_CDC} SELECT table_name, op, ts_ms, json_extract_string(b, '$.order_status') AS status_before,
        json_extract_string(a, '$.order_status') AS status_after FROM m""",
    ),
    Query(
        "cdc_operation_label",
        lambda sp, sf: _cdc(sp, sf).groupBy("op", c.cdc_operation_label(F.col("op")).alias("label")).agg(
            F.count(F.lit(1)).alias("changes")
        ),
        f"WITH {_ALL_CDC} SELECT op, {_LABEL} AS label, count(*) AS changes FROM m GROUP BY 1, 2",
    ),
    Query(
        "cdc_to_row",
        lambda sp, sf: c.cdc_to_row(_cdc(sp, sf, ("orders",)), now=moment(NOW)).select(
            "cdc_table", "cdc_operation", "cdc_timestamp",
            F.col("before_data").isNotNull().alias("has_before"),
            F.col("cols")["order_id"].cast("bigint").alias("order_id"),
            F.col("cols")["total_amount"].cast("double").alias("total_amount"),
            F.get_json_object("raw_payload", "$.order_status").alias("payload_status"),
            F.col("cols")["delivery_type"].alias("col_delivery_type"),
            "ingested_at",
        ),
        f"""WITH {_ORDER_CDC} SELECT table_name AS cdc_table, {_LABEL} AS cdc_operation,
        make_timestamp(ts_ms * 1000) AS cdc_timestamp, b IS NOT NULL AS has_before,
        CAST(json_extract_string(a, '$.order_id') AS BIGINT) AS order_id,
        CAST(json_extract_string(a, '$.total_amount') AS DOUBLE) AS total_amount,
        json_extract_string(coalesce(a, b), '$.order_status') AS payload_status,
        json_extract_string(a, '$.delivery_type') AS col_delivery_type, TIMESTAMP '{NOW}' AS ingested_at FROM m""",
        "total_amount",
    ),
]
