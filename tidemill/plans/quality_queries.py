"""Registered queries of data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.operators import alerts as a
from tidemill.operators import checks as q
from tidemill.operators import rules as r
from tidemill.plans.pay_queries import transactions
from tidemill.plans.query import Query, div, pc
from tidemill.sources import driver_tables as t

AS_OF, AT = t.EVENTS_AS_OF, t.EVENTS_AS_OF_TS
ORDERS_AT = "2001-08-03 00:30:00"
DAY = "2024-01-30"
_D = "CAST(event_timestamp AS DATE)"


def _freshness_sql(table: str, at: str, limit: int) -> str:
    return f"""SELECT 'freshness' AS check_name, '{table}' AS table_name,
    CASE WHEN m IS NULL OR m > {limit} THEN 'FAIL' WHEN m > {limit * 0.8} THEN 'WARN' ELSE 'PASS' END AS status,
    CAST(m AS DOUBLE) AS metric_value, CAST({limit} AS DOUBLE) AS threshold,
    CASE WHEN m IS NULL THEN 'the table is empty'
        ELSE 'last arrival ' || m || ' min ago, at most {limit} min allowed' END AS details, TIMESTAMP '{at}' AS checked_at
    FROM (SELECT datesub('minute', max(ingested_at), TIMESTAMP '{at}') AS m FROM {table})"""


def _volume_sql(table: str, as_of: str, column: str) -> str:
    return f"""SELECT 'volume_anomaly' AS check_name, '{table}' AS table_name,
    CASE WHEN today IS NULL THEN 'WARN' WHEN z > 2 THEN 'FAIL' ELSE 'PASS' END AS status,
    CASE WHEN today IS NOT NULL THEN z END AS metric_value, CAST(2 AS DOUBLE) AS threshold,
    CASE WHEN today IS NULL THEN 'no rows on the day before' ELSE format('{{:,}}', today) || ' rows against a mean of '
        || format('{{:,}}', CAST(round_even(mean, 0) AS BIGINT)) || ', ' || format('{{:.2f}}', z) || ' deviations away'
        END AS details,
    TIMESTAMP '{as_of} 00:00:00' AS checked_at
    FROM (SELECT today, mean, coalesce(abs(today - mean) / nullif(std, 0), 0) AS z FROM (
        SELECT max(n) FILTER (WHERE dt = DATE '{as_of}' - 1) AS today, avg(n) FILTER (WHERE dt < DATE '{as_of}') AS mean,
            stddev_samp(n) FILTER (WHERE dt < DATE '{as_of}') AS std FROM (
            SELECT CAST({column} AS DATE) AS dt, count(*) AS n FROM {table}
            WHERE CAST({column} AS DATE) >= DATE '{as_of}' - 14 GROUP BY 1)))"""


def _null_sql(columns) -> str:
    parts = [
        f"""SELECT 'null_rate_{c}' AS check_name, 'user_events' AS table_name,
        CASE WHEN x IS NULL THEN 'WARN' WHEN x > 0.05 THEN 'FAIL' ELSE 'PASS' END AS status, x AS metric_value,
        CAST(0.05 AS DOUBLE) AS threshold, CASE WHEN x IS NULL THEN 'no rows to look at' ELSE
        '{c} is missing in ' || format('{{:.2f}}%', x * 100) || ' of rows, 5.00% allowed' END AS details, TIMESTAMP '{DAY} 00:00:00' AS checked_at
        FROM (SELECT CAST(count(*) - count({c}) AS DOUBLE) / nullif(count(*), 0) AS x FROM user_events
        WHERE {_D} = DATE '{DAY}')"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


_DUP_SQL = f"""SELECT 'duplicate_rate' AS check_name, 'user_events' AS table_name,
    CASE WHEN n = 0 THEN 'WARN' WHEN x > 0.01 THEN 'FAIL' ELSE 'PASS' END AS status, x AS metric_value,
    CAST(0.01 AS DOUBLE) AS threshold,
    (n - u) || ' rows repeat a key (' || format('{{:.4f}}%', x * 100) || ')' AS details,
    TIMESTAMP '{DAY} 00:00:00' AS checked_at
    FROM (SELECT count(*) AS n, count(DISTINCT event_id) AS u, 1 - {div("count(DISTINCT event_id)", "count(*)")} AS x
    FROM user_events WHERE {_D} = DATE '{DAY}')"""
_NULL_COLUMNS = ("user_id", "session_id", "event_type")
_ALL_SQL = " UNION ALL ".join(
    [
        _freshness_sql("user_events", AT, 30),
        _freshness_sql("cdc_orders", ORDERS_AT, 15),
        _volume_sql("user_events", AS_OF, "event_timestamp"),
        _volume_sql("cdc_orders", ORDERS_AT[:10], "cdc_timestamp"),
        _null_sql(_NULL_COLUMNS),
        _DUP_SQL,
    ]
)


def _all_checks(spark, sf):
    return q.dq_run_all(t.user_events(spark, sf), t.changes(spark, sf, "orders"), AT, ORDERS_AT)


def _freshness(spark, sf):
    tables = {
        "user_events": (t.user_events(spark, sf), "ingested_at", "event_timestamp"),
        "cdc_orders": (t.changes(spark, sf, "orders"), "ingested_at", "cdc_timestamp"),
    }
    return q.pipeline_freshness(tables, AT)


_FRESH_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, max(ingested_at) AS last_ingested_at,
    datesub('minute', max(ingested_at), TIMESTAMP '{AT}') AS freshness_minutes, count(*) AS total_rows,
    count(DISTINCT CAST({column} AS DATE)) AS date_coverage FROM {name}"""
    for name, column in (("user_events", "event_timestamp"), ("cdc_orders", "cdc_timestamp"))
)


# ---- suites


def pay_events_with_users(spark, sf):
    """Payment events with the creation time of their user, taken from the first event of each user."""
    events = t.pay_events(spark, sf)
    users = events.groupBy("user_id").agg(F.min("_ingested_at").alias("created_at"))
    return r.with_user_created_at(events, users)


_EVENTS_FROM = """(SELECT e.*, c.user_created_at FROM pay_events e LEFT JOIN
    (SELECT user_id, min(_ingested_at) AS user_created_at FROM pay_events GROUP BY 1) c ON e.user_id = c.user_id)"""


def _rule_sql(suite: str, i: int, rule: r.Rule, source: str) -> str:
    c = (rule.column or "").removeprefix("properties.")
    label = "NULL::VARCHAR" if rule.column is None else f"'{rule.column}'"
    seen, bad, observed, ok = f"count({c})" if c else "0", "NULL", "NULL::DOUBLE", None
    if rule.kind == "not_null":
        seen, bad = "count(*)", f"count(*) - count({c})"
    elif rule.kind == "match_regex":
        bad = f"count(*) FILTER (WHERE NOT regexp_matches({c}, '{rule.regex}'))"
    elif rule.kind == "in_set":
        values = ", ".join(f"'{v}'" for v in rule.values)
        bad = f"count(*) FILTER (WHERE {c} NOT IN ({values}))"
    elif rule.kind == "between":
        tests = []
        if rule.low is not None:
            tests.append(f"{c} {'<=' if rule.strict_low else '<'} {rule.low}")
        if rule.high is not None:
            tests.append(f"{c} > {rule.high}")
        bad = f"count(*) FILTER (WHERE {' OR '.join(tests)})"
    elif rule.kind == "pair_a_ge_b":
        seen = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {rule.other} IS NOT NULL)"
        bad = f"count(*) FILTER (WHERE {c} < {rule.other})"
    elif rule.kind == "unique":
        bad = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count({c}) AS n FROM {source} GROUP BY {c} HAVING count({c}) > 1))"
    elif rule.kind == "row_count":
        observed = "CAST(count(*) AS DOUBLE)"
    elif rule.kind == "mean":
        observed = f"avg({c})"
    elif rule.kind == "unique_proportion":
        observed = div(f"count(DISTINCT {c})", f"count({c})")
    if bad == "NULL":
        ok = f"coalesce(observed_value BETWEEN {rule.low} AND {rule.high}, false)"
    else:
        ok = f"coalesce(CAST(seen - bad AS DOUBLE) / nullif(seen, 0), 1) >= {rule.mostly}"
    return f"""SELECT '{suite}' AS suite, {i} AS rule_no, '{rule.kind}' AS expectation, {label} AS column,
    '{rule.priority}' AS priority, '{rule.category}' AS category, observed_value, element_count,
    CAST(bad AS BIGINT) AS unexpected_count, 100.0 * bad / nullif(seen, 0) AS unexpected_percent, {ok} AS success
    FROM (SELECT {observed} AS observed_value, count(*) AS element_count, {seen} AS seen, {bad} AS bad FROM {source} AS src)"""


def _suite_sql(suite: str, rules, source: str) -> str:
    return " UNION ALL ".join(_rule_sql(suite, i, rule, source) for i, rule in enumerate(rules, 1))


EVENTS, TXNS = "events_suite", "transactions_suite"
_BOTH_SQL = (
    _suite_sql(EVENTS, r.events_suite(), _EVENTS_FROM)
    + " UNION ALL "
    + _suite_sql(TXNS, r.transactions_suite(), "stg_transactions")
)


def _suites(spark, sf):
    events = r.dq_suite_run(
        pay_events_with_users(spark, sf), r.events_suite(), EVENTS, plain=t.pay_events(spark, sf)
    )
    return events.unionByName(r.dq_suite_run(transactions(spark, sf), r.transactions_suite(), TXNS))


_RESULT_TYPES = {"floats": "observed_value unexpected_percent", "ints": "rule_no element_count unexpected_count"}


def _one_rule(key: str, rule: r.Rule, source: str = "pay_events") -> Query:
    def run(spark, sf):
        if source != "pay_events":
            df = transactions(spark, sf)
        elif rule.kind == "pair_a_ge_b":
            df = pay_events_with_users(spark, sf)
        else:
            df = t.pay_events(spark, sf)
        return r.dq_suite_run(df, [rule], key)

    from_sql = _EVENTS_FROM if source == "pay_events" else source
    return Query(key, run, _suite_sql(key, [rule], from_sql), **_RESULT_TYPES)


_ES, _TS = r.events_suite(), r.transactions_suite()

QUERIES = [
    Query(
        "dq_freshness",
        lambda sp, sf: q.dq_freshness(t.user_events(sp, sf), "user_events", AT, 30),
        _freshness_sql("user_events", AT, 30),
        "metric_value",
    ),
    Query(
        "dq_volume_zscore",
        lambda sp, sf: q.dq_volume_zscore(t.user_events(sp, sf), "user_events", AS_OF),
        _volume_sql("user_events", AS_OF, "event_timestamp"),
        "metric_value",
    ),
    Query(
        "dq_null_rates",
        lambda sp, sf: q.dq_null_rates(t.user_events(sp, sf), "user_events", _NULL_COLUMNS, DAY),
        _null_sql(_NULL_COLUMNS),
        "metric_value",
    ),
    Query(
        "dq_duplicate_rate",
        lambda sp, sf: q.dq_duplicate_rate(t.user_events(sp, sf), "user_events", "event_id", DAY),
        _DUP_SQL,
        "metric_value",
    ),
    Query("dq_run_all", _all_checks, _ALL_SQL, "metric_value"),
    Query(
        "dq_summary",
        lambda sp, sf: q.dq_summary(_all_checks(sp, sf)),
        f"""SELECT count(*) AS total, count(*) FILTER (WHERE status = 'PASS') AS passed,
        count(*) FILTER (WHERE status = 'WARN') AS warnings, count(*) FILTER (WHERE status = 'FAIL') AS failed,
        count(*) FILTER (WHERE status = 'FAIL' AND check_name IN ('freshness', 'volume_anomaly')) AS critical
        FROM ({_ALL_SQL})""",
    ),
    Query("table_freshness", _freshness, _FRESH_SQL),
    _one_rule("expect_not_null", _ES[1]),
    _one_rule("expect_match_regex", _ES[3]),
    _one_rule("expect_in_set", _ES[4]),
    _one_rule("expect_between", _ES[5]),
    _one_rule("expect_pair_a_ge_b", _ES[6]),
    _one_rule("expect_unique", _TS[1], "stg_transactions"),
    _one_rule("expect_row_count", _ES[8]),
    _one_rule("expect_unique_proportion", _ES[9]),
    _one_rule("expect_mean", _TS[6], "stg_transactions"),
    Query("dq_suite_run", _suites, _BOTH_SQL, **_RESULT_TYPES),
    Query(
        "dq_failures",
        lambda sp, sf: a.dq_failures(_suites(sp, sf)),
        f"""WITH res AS ({_BOTH_SQL}), f AS (SELECT *, min(priority) OVER (PARTITION BY suite) AS max_priority
            FROM res WHERE NOT success)
        SELECT suite, rule_no, expectation, "column", priority, category, observed_value, element_count, unexpected_percent,
            max_priority, CASE max_priority WHEN 'P0' THEN 'critical' WHEN 'P1' THEN 'alerts'
            ELSE 'summary' END AS channel, CASE max_priority WHEN 'P0' THEN 'halt'
            WHEN 'P1' THEN 'review' ELSE 'report' END AS action, max_priority = 'P0' AS should_halt FROM f""",
        "observed_value unexpected_percent",
        "rule_no element_count",
    ),
    Query(
        "dq_daily_summary",
        lambda sp, sf: a.dq_daily_summary(_suites(sp, sf)),
        f"""SELECT count(*) AS total_suites, count(*) FILTER (WHERE n = 0) AS passed_suites,
        count(*) FILTER (WHERE n > 0) AS failed_suites, sum(n) AS failed_rules
        FROM (SELECT suite, count(*) FILTER (WHERE NOT success) AS n FROM ({_BOTH_SQL}) GROUP BY 1)""",
        ints="failed_rules",
    ),
    Query(
        "dq_alert_branch",
        lambda sp, sf: a.dq_alert_branch(_suites(sp, sf)),
        f"SELECT CASE WHEN bool_or(NOT success) THEN 'send_critical_alert' ELSE 'send_summary' END AS branch FROM ({_BOTH_SQL})",
    ),
    Query(
        "quality_scorecard",
        lambda sp, sf: a.quality_scorecard(_suites(sp, sf)),
        f"""WITH s AS (SELECT category, success, coalesce(100 - unexpected_percent, CASE WHEN success THEN 100 ELSE 0 END) AS x
            FROM ({_BOTH_SQL}))
        SELECT category, avg(x) AS score, count(*) AS rules, count(*) FILTER (WHERE NOT success) AS failed_rules
        FROM (SELECT * FROM s UNION ALL SELECT 'overall', success, x FROM s) GROUP BY 1""",
        "score",
    ),
    Query(
        "dq_volume_change",
        lambda sp, sf: q.dq_volume_change(t.pay_events(sp, sf), DAY),
        f"""SELECT *, round({pc("(today_count - yesterday_count)", "yesterday_count")}, 1) AS change_pct,
        abs({pc("(today_count - yesterday_count)", "yesterday_count")}) > 50 AS anomaly
        FROM (SELECT count(*) FILTER (WHERE {_D} = DATE '2024-01-30') AS today_count,
        count(*) FILTER (WHERE {_D} = DATE '2024-01-29') AS yesterday_count FROM pay_events)""",
        "change_pct",
    ),
    Query(
        "quality_gauges",
        lambda sp, sf: q.quality_gauges(_all_checks(sp, sf)),
        f"""WITH c AS ({_ALL_SQL}) SELECT check_name, table_name, 'data_quality_check_status' AS gauge,
            NULL::VARCHAR AS column_name, CASE WHEN status = 'PASS' THEN 1.0 ELSE 0.0 END AS value FROM c
        UNION ALL SELECT check_name, table_name, CASE WHEN check_name = 'freshness' THEN 'data_freshness_minutes'
            WHEN check_name = 'volume_anomaly' THEN 'data_volume_zscore' ELSE 'data_null_rate' END,
            CASE WHEN check_name LIKE 'null_rate_%' THEN replace(check_name, 'null_rate_', '') END, metric_value
        FROM c WHERE check_name <> 'duplicate_rate'""",
        "value",
    ),
    Query(
        "schema_drift",
        lambda sp, sf: q.schema_drift(t.given(sp, sf, "events"), schemas.RAW_USER_EVENTS),
        """SELECT v.*, CASE WHEN actual IS NULL THEN 0 ELSE (SELECT count(*) FROM events) END AS filled_rows FROM (VALUES
        ('event_id', 'string', 'bigint'), ('event_timestamp', 'timestamp', NULL), ('session_id', 'string', NULL),
        ('device_type', 'string', NULL), ('device_id', 'string', NULL), ('app_version', 'string', NULL),
        ('page_url', 'string', NULL), ('referrer', 'string', NULL), ('utm_source', 'string', NULL),
        ('utm_medium', 'string', NULL), ('utm_campaign', 'string', NULL), ('properties', 'string', NULL),
        ('ingested_at', 'timestamp', NULL), ('ts', NULL, 'timestamp_ntz'), ('value', NULL, 'double'),
        ('props', NULL, 'string')) v("column", expected, actual)""",
    ),
]
