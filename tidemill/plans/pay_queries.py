"""Registered queries of the payment half."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import engagement as g
from tidemill.operators import payments as p
from tidemill.operators import service as v
from tidemill.operators import staging as st
from tidemill.operators import taxonomy as x
from tidemill.plans.query import Query, div, pc
from tidemill.sources import driver_tables as t

AS_OF = t.EVENTS_AS_OF


def staged(spark, sf):
    return st.stg_events(t.pay_events(spark, sf), AS_OF)


def transactions(spark, sf):
    return st.stg_transactions(staged(spark, sf))


def _flat(df):
    return df.select(*[c for c in df.columns if c != "properties"], "properties.*")


_D = "CAST(event_timestamp AS DATE)"

# one row per paid transaction with its refunds
_NET = f"""net AS (SELECT q.*, coalesce(r.refund, 0) AS refund, gross - coalesce(r.refund, 0) AS net FROM
    (SELECT {_D} AS dt, user_id, transaction_id, amount AS gross, payment_method, merchant_category, is_first_payment,
        row_number() OVER (PARTITION BY transaction_id ORDER BY event_timestamp, event_id) AS rn FROM stg_events
        WHERE event_name = 'payment.complete.payment_success' AND amount > 0 AND transaction_id IS NOT NULL) q
    LEFT JOIN (SELECT transaction_id, sum(amount) AS refund FROM stg_events
        WHERE event_name = 'payment.complete.refund' GROUP BY 1) r ON q.transaction_id = r.transaction_id
    WHERE q.rn = 1)"""


def _arppu_sql(period: str, name: str) -> str:
    first = "count(DISTINCT CASE WHEN is_first_payment THEN user_id END)"
    return f"""WITH {_NET} SELECT {period} AS {name}, count(DISTINCT user_id) AS paying_users,
    count(transaction_id) AS total_transactions, sum(gross) AS gross_revenue, sum(refund) AS total_refunds,
    sum(net) AS net_revenue, {div("sum(net)", "count(DISTINCT user_id)")} AS arppu,
    {div("sum(net)", "count(*)")} AS avg_transaction_amount, {pc(first, "count(DISTINCT user_id)")} AS first_payment_user_pct,
    {pc("count(*) FILTER (WHERE payment_method = 'card')", "count(*)")} AS card_pct,
    {pc("count(*) FILTER (WHERE payment_method = 'app_balance')", "count(*)")} AS app_balance_pct
    FROM net WHERE net > 0 GROUP BY 1"""


_ARPPU_TYPES = {
    "floats": "arppu avg_transaction_amount first_payment_user_pct card_pct app_balance_pct",
    "ints": "gross_revenue total_refunds net_revenue",
}


def _net_of_staged(body: str) -> str:
    """Completed payments with what is left of them after all refunds of the same transaction."""
    return f"""WITH paid AS (SELECT *, amount - coalesce((SELECT sum(back.amount) FROM stg_transactions AS back
            WHERE back.transaction_status = 'REFUNDED' AND back.transaction_id = t.transaction_id), 0) AS net
        FROM stg_transactions AS t WHERE transaction_status = 'COMPLETED' AND NOT payment_method = 'transfer'),
    net AS (SELECT {_D} AS dt, user_id, transaction_id, amount AS gross, amount - net AS refund, net, payment_method,
        merchant_category, is_first_payment FROM paid WHERE net > 0) {body}"""


_METHODS = ("card", "bank_transfer", "app_balance")
_REVENUE_SQL = _net_of_staged(
    f""", users AS (SELECT dt, user_id, count(*) AS n, sum(gross) AS gross, sum(refund) AS refund, sum(net) AS net,
        bool_or(coalesce(is_first_payment, false)) AS is_new,
        {", ".join(f"count_if(payment_method = '{m}') AS {m}" for m in _METHODS)} FROM net GROUP BY dt, user_id),
    days AS (SELECT dt, count(user_id) AS paying_users, sum(n) AS total_transactions, sum(gross) AS gross_revenue,
        sum(refund) AS total_refunds, sum(net) AS net_revenue, count_if(is_new AND user_id IS NOT NULL) AS new_paying_users,
        {", ".join(f"sum({m}) AS {m}" for m in _METHODS)} FROM users GROUP BY dt),
    best AS (SELECT dt, list({{'merchant_category': merchant_category, 'net_amount': CAST(net AS BIGINT)}}
        ORDER BY net DESC, merchant_category ASC NULLS LAST, transaction_id) AS every FROM net GROUP BY dt)
    SELECT dt, paying_users, CAST(total_transactions AS BIGINT) AS total_transactions, gross_revenue, total_refunds,
        net_revenue, {div("net_revenue", "paying_users")} AS arppu, {div("net_revenue", "total_transactions")} AS avg_txn_amount,
        new_paying_users, {pc("new_paying_users", "paying_users")} AS new_paying_user_pct,
        {", ".join(f"{pc(m, 'total_transactions')} AS {m}_pct" for m in _METHODS)},
        CAST(to_json(every[1:5]) AS VARCHAR) AS top_merchant_categories FROM days JOIN best USING (dt)"""
)
_FUNNEL_SQL = f"""SELECT CAST(session_start AS DATE) AS dt, device_type, count(DISTINCT session_id) AS total_sessions,
    sum(has_payment_view) AS step1_payment_view, sum(has_method_select) AS step2_method_select,
    sum(has_payment_submit) AS step3_payment_submit, sum(has_payment_complete) AS step4_payment_complete,
    sum(has_payment_fail) AS payment_fail_sessions,
    {pc("sum(has_method_select)", "sum(has_payment_view)")} AS cvr_view_to_select,
    {pc("sum(has_payment_submit)", "sum(has_method_select)")} AS cvr_select_to_submit,
    {pc("sum(has_payment_complete)", "sum(has_payment_submit)")} AS cvr_submit_to_complete,
    {pc("sum(has_payment_complete)", "sum(has_payment_view)")} AS overall_payment_cvr,
    {pc("sum(has_payment_fail)", "sum(has_payment_submit)")} AS payment_failure_rate
    FROM int_user_sessions WHERE has_payment_view = 1 GROUP BY 1, 2"""
_RETENTION_SQL = f"""SELECT f.cohort_date, s.cohort_users, datediff('day', f.cohort_date, a.d) AS day_n,
    count(DISTINCT f.user_id) AS returned_users, {pc("count(DISTINCT f.user_id)", "s.cohort_users")} AS retention_rate
    FROM cohorts f JOIN logins a ON f.user_id = a.user_id AND a.d >= f.cohort_date
        AND datediff('day', f.cohort_date, a.d) <= 30
    JOIN (SELECT cohort_date, count(*) AS cohort_users FROM cohorts GROUP BY 1) s ON f.cohort_date = s.cohort_date
    WHERE f.cohort_date >= DATE '2024-01-31' - INTERVAL 60 DAY GROUP BY 1, 2, 3"""
_POINTS = (0, 1, 3, 7, 14, 30)
_ACTIVE_SQL = f"""WITH dd AS (SELECT DISTINCT d FROM logins),
    r AS (SELECT dd.d, count(DISTINCT CASE WHEN l.d = dd.d THEN user_id END) AS dau,
        count(DISTINCT CASE WHEN l.d > dd.d - INTERVAL 7 DAY THEN user_id END) AS wau, count(DISTINCT user_id) AS mau
        FROM dd JOIN logins l ON l.d <= dd.d AND l.d > dd.d - INTERVAL 30 DAY GROUP BY 1),
    dev AS (SELECT {_D} AS d, count(DISTINCT CASE WHEN device_type = 'ios' THEN user_id END) AS dau_ios,
        count(DISTINCT CASE WHEN device_type = 'android' THEN user_id END) AS dau_android,
        count(DISTINCT CASE WHEN device_type = 'web' THEN user_id END) AS dau_web FROM stg_events
        WHERE event_name = 'auth.complete.login' AND user_id NOT LIKE 'anonymous_%' GROUP BY 1)
    SELECT r.d AS dt, dau, wau, mau, {pc("dau", "mau")} AS stickiness_pct, dau_ios, dau_android, dau_web
    FROM r JOIN dev ON r.d = dev.d"""


def _domain_sql() -> str:
    parts = []
    for name, category, top, bottom in v.DOMAIN_RULES:

        def hits(actions):
            listed = ", ".join(f"'{a}'" for a in actions)
            return f"count(*) FILTER (WHERE event_category = '{category}' AND event_action IN ({listed}))"

        parts.append(
            f"SELECT {_D} AS dt, '{name}' AS metric, {hits(top)} AS numerator, {hits(bottom)} AS denominator, "
            f"{pc(hits(top), hits(bottom))} AS value FROM stg_events GROUP BY 1"
        )
    w = "event_category = 'transfer' AND event_action = 'complete'"
    parts.append(
        f"SELECT {_D}, 'avg_transfer_amount', coalesce(sum(amount) FILTER (WHERE {w}), 0), "
        f"count(amount) FILTER (WHERE {w}), avg(amount) FILTER (WHERE {w}) FROM stg_events GROUP BY 1"
    )
    return " UNION ALL ".join(parts)


def _kpi(spark, sf):
    events = staged(spark, sf)
    return v.kpi_snapshot(
        g.active_users(events, AS_OF),
        p.mart_revenue(transactions(spark, sf)),
        p.mart_payment_funnel(p.int_user_sessions(events)),
        g.mart_user_retention(events, AS_OF),
        AS_OF,
    )


def _active_approx(spark, sf):
    """Exact counts, and whether the sketched ones lie within 5 % of them: a sketch itself differs between engines."""
    names = ("dau", "wau", "mau")
    exact = g.active_users(staged(spark, sf), AS_OF).select("dt", *names)
    near = g.active_users(staged(spark, sf), AS_OF, approx=True).select("dt", *[F.col(n).alias(f"_{n}") for n in names])
    close = [(F.abs(F.col(f"_{n}") - F.col(n)) <= 0.05 * F.col(n)).alias(f"{n}_near") for n in names]
    return exact.join(near, "dt").select("dt", *names, *close)


_KPI_SQL = f"""WITH a AS ({_ACTIVE_SQL}), rev AS ({_REVENUE_SQL}),
    cv AS (SELECT CAST(session_start AS DATE) AS dt,
        {pc("sum(has_payment_complete)", "sum(has_payment_view)")} AS c FROM int_user_sessions
        WHERE has_payment_view = 1 GROUP BY 1),
    ret AS ({_RETENTION_SQL}),
    k AS (SELECT 'dau' AS kpi, (SELECT dau FROM a WHERE dt = DATE '2024-01-30')::DOUBLE AS value,
            (SELECT dau FROM a WHERE dt = DATE '2024-01-29')::DOUBLE AS previous
        UNION ALL SELECT 'net_revenue', (SELECT net_revenue FROM rev WHERE dt = DATE '2024-01-30')::DOUBLE,
            (SELECT net_revenue FROM rev WHERE dt = DATE '2024-01-29')::DOUBLE
        UNION ALL SELECT 'arppu', (SELECT arppu FROM rev WHERE dt = DATE '2024-01-30'),
            (SELECT arppu FROM rev WHERE dt = DATE '2024-01-29')
        UNION ALL SELECT 'payment_cvr', (SELECT c FROM cv WHERE dt = DATE '2024-01-30'),
            (SELECT c FROM cv WHERE dt = DATE '2024-01-29')
        UNION ALL SELECT 'd7_retention',
            (SELECT retention_rate FROM ret WHERE day_n = 7 AND cohort_date = DATE '2024-01-23'),
            (SELECT retention_rate FROM ret WHERE day_n = 7 AND cohort_date = DATE '2024-01-16'))
    SELECT *, 100.0 * (value - previous) / nullif(previous, 0) AS change_pct FROM k"""

_SETS_SQL = f"""WITH f AS (SELECT user_id, min({_D}) AS d FROM stg_events WHERE event_name = 'auth.complete.login' GROUP BY 1),
    e AS (SELECT *, {_D} AS dt FROM stg_events), days AS (SELECT DISTINCT dt FROM e)
    SELECT dt, 'active_user' AS set_name, count(DISTINCT CASE WHEN event_name = 'auth.complete.login' THEN user_id END) AS value
    FROM e GROUP BY 1
    UNION ALL SELECT dt, 'transaction', count(*) FILTER (WHERE event_name = 'payment.complete.payment_success'
        OR event_name LIKE 'transfer.complete.%') FROM e GROUP BY 1
    UNION ALL SELECT dt, 'paying_user', count(DISTINCT CASE WHEN event_name = 'payment.complete.payment_success'
        THEN user_id END) FROM e GROUP BY 1
    UNION ALL SELECT dt, 'revenue', sum(CASE WHEN event_name = 'payment.complete.payment_success' THEN coalesce(amount, 0)
        WHEN event_name = 'payment.complete.refund' THEN -coalesce(amount, 0) ELSE 0 END) FROM e GROUP BY 1
    UNION ALL SELECT days.dt, 'first_day', count(f.user_id) FROM days LEFT JOIN f ON f.d = days.dt GROUP BY 1"""

QUERIES = [
    Query(
        "parse_taxonomy",
        lambda sp, sf: x.parse_taxonomy(t.pay_events(sp, sf)).select(
            "event_id", "event_name", "event_category", "event_action", "event_label", "is_valid"
        ),
        """SELECT event_id, event_name, split_part(event_name, '.', 1) AS event_category,
        nullif(split_part(event_name, '.', 2), '') AS event_action, nullif(split_part(event_name, '.', 3), '') AS event_label,
        regexp_matches(event_name, '^[a-z_]+\\.[a-z_]+\\.[a-z_]+$') AS is_valid FROM pay_events""",
    ),
    Query("stg_events", lambda sp, sf: _flat(staged(sp, sf)), "SELECT * FROM stg_events"),
    Query("stg_transactions", transactions, "SELECT * FROM stg_transactions"),
    Query(
        "int_user_sessions",
        lambda sp, sf: p.int_user_sessions(staged(sp, sf)),
        "SELECT * FROM int_user_sessions",
        ints="has_login has_payment_view has_method_select has_payment_submit has_payment_complete "
        "has_payment_fail has_transfer_view has_transfer_complete has_error",
    ),
    Query(
        "mart_payment_funnel",
        lambda sp, sf: p.mart_payment_funnel(p.int_user_sessions(staged(sp, sf))),
        _FUNNEL_SQL,
        "cvr_view_to_select cvr_select_to_submit cvr_submit_to_complete overall_payment_cvr payment_failure_rate",
        "step1_payment_view step2_method_select step3_payment_submit step4_payment_complete payment_fail_sessions",
    ),
    Query(
        "mart_revenue",
        lambda sp, sf: p.mart_revenue(transactions(sp, sf)),
        _REVENUE_SQL,
        "arppu avg_txn_amount new_paying_user_pct card_pct bank_transfer_pct app_balance_pct",
        "gross_revenue total_refunds net_revenue",
    ),
    Query(
        "mart_user_retention",
        lambda sp, sf: g.mart_user_retention(staged(sp, sf), AS_OF),
        _RETENTION_SQL,
        "retention_rate",
    ),
    Query(
        "payment_funnel_dropoff",
        lambda sp, sf: p.payment_funnel_dropoff(staged(sp, sf), AS_OF),
        f"""SELECT dt, device_type, sum(v) AS funnel_view, sum(s) AS funnel_select, sum(r) AS funnel_submit,
        sum(c) AS funnel_complete, {pc("sum(s)", "sum(v)")} AS cvr_1to2_pct, {pc("sum(r)", "sum(s)")} AS cvr_2to3_pct,
        {pc("sum(c)", "sum(r)")} AS cvr_3to4_pct, {pc("sum(c)", "sum(v)")} AS overall_cvr_pct,
        greatest(sum(v) - sum(s), sum(s) - sum(r), sum(r) - sum(c)) AS max_dropoff_count,
        avg(CASE WHEN c = 1 THEN sec END) AS avg_completion_time_sec, {pc("sum(e)", "count(*)")} AS error_session_pct
        FROM (SELECT CAST(min(event_timestamp) AS DATE) AS dt, session_id, user_id, device_type,
            max(CAST(event_name LIKE 'payment.view.%' AS INT)) AS v,
            max(CAST(event_name = 'payment.click.payment_method_select' AS INT)) AS s,
            max(CAST(event_name = 'payment.submit.payment_request' AS INT)) AS r,
            max(CAST(event_name = 'payment.complete.payment_success' AS INT)) AS c,
            max(CAST(event_name LIKE 'payment.fail.%' AS INT)) AS e,
            datesub('second', min(event_timestamp), max(event_timestamp)) AS sec FROM stg_events
            WHERE event_category = 'payment' AND {_D} BETWEEN DATE '2024-01-24' AND DATE '2024-01-30'
            GROUP BY session_id, user_id, device_type) GROUP BY 1, 2""",
        "cvr_1to2_pct cvr_2to3_pct cvr_3to4_pct overall_cvr_pct avg_completion_time_sec error_session_pct",
        "funnel_view funnel_select funnel_submit funnel_complete max_dropoff_count",
    ),
    Query(
        "retention_pivot",
        lambda sp, sf: g.retention_pivot(staged(sp, sf), AS_OF, min_cohort=10),
        f"""WITH uc AS (SELECT user_id, min(d) AS cohort_date FROM logins WHERE d >= DATE '2024-01-31' - INTERVAL 60 DAY GROUP BY 1),
        cr AS (SELECT cohort_date, datediff('day', cohort_date, d) AS n, count(DISTINCT uc.user_id) AS u FROM uc
            JOIN logins ON uc.user_id = logins.user_id AND d >= cohort_date AND datediff('day', cohort_date, d) <= 30 GROUP BY 1, 2),
        cs AS (SELECT cohort_date, count(*) AS cohort_size FROM uc GROUP BY 1)
        SELECT cr.cohort_date, cohort_size, {", ".join(f"max(CASE WHEN n = {n} THEN round(100.0 * u / cohort_size, 1) END) AS d{n}" for n in _POINTS)}
        FROM cr JOIN cs ON cr.cohort_date = cs.cohort_date WHERE cohort_size >= 10 GROUP BY 1, 2""",
        " ".join(f"d{n}" for n in _POINTS),
    ),
    Query(
        "retention_long",
        lambda sp, sf: g.retention_long(staged(sp, sf), AS_OF),
        f"""WITH r AS ({_RETENTION_SQL}) SELECT *, {", ".join(
            f"max(CASE WHEN day_n = {n} THEN retention_rate END) OVER (PARTITION BY cohort_date) AS d{n}_retention"
            for n in _POINTS[1:])} FROM r""",
        "retention_rate " + " ".join(f"d{n}_retention" for n in _POINTS[1:]),
    ),
    Query(
        "retention_weekly_cohort",
        lambda sp, sf: g.retention_weekly_cohort(staged(sp, sf), AS_OF),
        f"""WITH c AS (SELECT user_id, cohort_date, CAST(cohort_date - CAST(dayofweek(cohort_date) AS INT) AS DATE) AS w FROM cohorts),
        s AS (SELECT w, count(*) AS cohort_users FROM c GROUP BY 1)
        SELECT c.w AS cohort_week, s.cohort_users, {", ".join(
            pc(f"count(DISTINCT CASE WHEN datediff('day', cohort_date, d) = {n} THEN c.user_id END)", "s.cohort_users")
            + f" AS d{n}" for n in _POINTS)}
        FROM c JOIN logins ON c.user_id = logins.user_id JOIN s ON c.w = s.w
        WHERE cohort_date >= DATE '2024-01-31' - INTERVAL 60 DAY GROUP BY 1, 2""",
        " ".join(f"d{n}" for n in _POINTS),
    ),
    Query(
        "revenue_analysis",
        lambda sp, sf: p.revenue_analysis(staged(sp, sf)),
        f"""WITH {_NET}, dm AS (SELECT dt, count(DISTINCT user_id) AS paying_users, count(*) AS txn_count,
            sum(gross) AS gross_revenue, sum(refund) AS total_refund, sum(net) AS net_revenue,
            {div("sum(net)", "count(DISTINCT user_id)")} AS arppu, {div("sum(net)", "count(*)")} AS avg_txn_amount,
            count(DISTINCT CASE WHEN is_first_payment THEN user_id END) AS new_payers FROM net WHERE net > 0 GROUP BY 1),
        sh AS (SELECT dt, {pc("sum(CASE WHEN payment_method = 'card' THEN net ELSE 0 END)", "sum(net)")} AS card_revenue_pct,
            {pc("sum(CASE WHEN payment_method = 'app_balance' THEN net ELSE 0 END)", "sum(net)")} AS app_balance_revenue_pct
            FROM net GROUP BY 1)
        SELECT dm.*, {pc("(net_revenue - lag(net_revenue) OVER (ORDER BY dm.dt))", "lag(net_revenue) OVER (ORDER BY dm.dt)")}
            AS revenue_change_pct,
            avg(net_revenue) OVER (ORDER BY dm.dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS revenue_7d_ma,
            card_revenue_pct, app_balance_revenue_pct FROM dm JOIN sh ON dm.dt = sh.dt""",
        "arppu avg_txn_amount revenue_change_pct revenue_7d_ma card_revenue_pct app_balance_revenue_pct",
        "gross_revenue total_refund net_revenue",
    ),
    Query(
        "active_users",
        lambda sp, sf: g.active_users(staged(sp, sf), AS_OF),
        _ACTIVE_SQL,
        "stickiness_pct",
    ),
    Query(
        "active_users_approx",
        _active_approx,
        f"SELECT dt, dau, wau, mau, true AS dau_near, true AS wau_near, true AS mau_near FROM ({_ACTIVE_SQL})",
    ),
    Query("arppu_daily", lambda sp, sf: p.arppu_daily(staged(sp, sf)), _arppu_sql("dt", "dt"), **_ARPPU_TYPES),
    Query(
        "arppu_monthly",
        lambda sp, sf: p.arppu_monthly(staged(sp, sf)),
        _arppu_sql("CAST(date_trunc('month', dt) AS DATE)", "month"),
        **_ARPPU_TYPES,
    ),
    Query(
        "payment_conversion_rate",
        lambda sp, sf: v.payment_conversion_rate(staged(sp, sf)),
        f"""SELECT dt, c AS complete_sessions, s AS checkout_sessions, {pc("c", "s")} AS payment_cvr_pct FROM (
        SELECT {_D} AS dt, count(DISTINCT CASE WHEN event_name = 'payment.complete.payment_success' THEN session_id END) AS c,
        count(DISTINCT CASE WHEN event_name = 'payment.view.checkout_screen' THEN session_id END) AS s
        FROM stg_events GROUP BY 1)""",
        "payment_cvr_pct",
    ),
    Query(
        "transfer_success_rate",
        lambda sp, sf: v.transfer_success_rate(staged(sp, sf)),
        f"""SELECT *, success_rate_pct >= 99.5 AS sla_met FROM (
        SELECT dt, completed, failed, {pc("completed", "(completed + failed)")} AS success_rate_pct FROM (
        SELECT {_D} AS dt, count(*) FILTER (WHERE event_action = 'complete') AS completed,
        count(*) FILTER (WHERE event_action = 'fail') AS failed FROM stg_events
        WHERE event_category = 'transfer' GROUP BY 1))""",
        "success_rate_pct",
    ),
    Query(
        "error_rate",
        lambda sp, sf: v.error_rate(staged(sp, sf)),
        f"""SELECT *, error_rate_pct < 1 AS sla_met FROM (SELECT dt, error_events, sessions,
        {pc("error_events", "sessions")} AS error_rate_pct FROM (
        SELECT {_D} AS dt, count(*) FILTER (WHERE event_category = 'error' AND event_action = 'occur') AS error_events,
        count(DISTINCT session_id) AS sessions FROM stg_events GROUP BY 1))""",
        "error_rate_pct",
        "error_events",
    ),
    Query("domain_rates", lambda sp, sf: v.domain_rates(staged(sp, sf)), _domain_sql(), "value", "numerator denominator"),
    Query("kpi_snapshot", _kpi, _KPI_SQL, "value previous change_pct"),
    Query(
        "payment_method_mix",
        lambda sp, sf: p.payment_method_mix(transactions(sp, sf)),
        f"""SELECT *, 100.0 * transactions / sum(transactions) OVER (PARTITION BY dt) AS transaction_share_pct,
        100.0 * revenue / sum(revenue) OVER (PARTITION BY dt) AS revenue_share_pct FROM (
        SELECT {_D} AS dt, payment_method, count(*) AS transactions, sum(amount) AS revenue FROM stg_transactions
        WHERE transaction_status = 'COMPLETED' GROUP BY 1, 2)""",
        "transaction_share_pct revenue_share_pct",
        "revenue",
    ),
    Query(
        "hourly_volume_band",
        lambda sp, sf: v.hourly_volume_band(staged(sp, sf), AS_OF),
        f"""SELECT *, expected * 0.7 AS low, expected * 1.3 AS high, CASE WHEN events < expected * 0.7 THEN 'below'
        WHEN events > expected * 1.3 THEN 'above' ELSE 'within' END AS status FROM (
        SELECT hour(event_timestamp) AS hour, count(*) FILTER (WHERE {_D} = DATE '2024-01-30') AS events,
        count(*) FILTER (WHERE {_D} < DATE '2024-01-30') / 14.0 AS expected FROM stg_events
        WHERE {_D} BETWEEN DATE '2024-01-16' AND DATE '2024-01-30' GROUP BY 1)""",
        "expected low high",
    ),
    Query("metric_base_sets", lambda sp, sf: v.metric_base_sets(staged(sp, sf)), _SETS_SQL, ints="value"),
    Query(
        "test_unique_transaction",
        lambda sp, sf: p.check_unique_transaction(transactions(sp, sf)),
        """SELECT transaction_id, count(*) AS cnt FROM stg_transactions WHERE transaction_status = 'COMPLETED'
        GROUP BY 1 HAVING count(*) > 1""",
    ),
    Query(
        # the same test in front of the de-duplication by transaction
        "test_unique_transaction_delivered",
        lambda sp, sf: p.check_unique_transaction(
            staged(sp, sf).filter(F.col("event_name") == p.SUCCESS)
            .select("properties.transaction_id", F.lit("COMPLETED").alias("transaction_status"))
        ),
        """SELECT transaction_id, count(*) AS cnt FROM stg_events WHERE event_name = 'payment.complete.payment_success'
        GROUP BY 1 HAVING count(*) > 1""",
    ),
    Query(
        "test_revenue_not_negative",
        lambda sp, sf: p.check_revenue_not_negative(p.mart_revenue(transactions(sp, sf))),
        f"""SELECT dt, net_revenue, gross_revenue, total_refunds FROM ({_REVENUE_SQL})
        WHERE net_revenue < 0 OR gross_revenue < 0""",
        ints="net_revenue gross_revenue total_refunds",
    ),
    Query(
        "test_arppu_reasonable",
        lambda sp, sf: p.check_arppu_reasonable(p.mart_revenue(transactions(sp, sf)), AS_OF, sigma=0.5),
        f"""WITH mr AS ({_REVENUE_SQL}), st AS (SELECT avg(arppu) AS avg_arppu, stddev_samp(arppu) AS std_arppu FROM mr
            WHERE dt >= DATE '2024-01-01')
        SELECT dt, arppu, avg_arppu, std_arppu, abs(arppu - avg_arppu) / nullif(std_arppu, 0) AS z_score FROM mr, st
        WHERE dt = DATE '2024-01-30' AND abs(arppu - avg_arppu) / nullif(std_arppu, 0) > 0.5""",
        "arppu avg_arppu std_arppu z_score",
    ),
]
