"""The mapped test tables as common table expressions for the checking engine."""

from __future__ import annotations

import re

from tidemill.sources import driver_tables as dt


def _cols(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


def _events_k() -> str:
    return f"(SELECT *, {dt.K} AS k FROM events)"


_LABEL = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}


def _versions(table: str) -> str:
    given, versions = dt.CHANGES[table]
    parts = [
        f"SELECT '{op}' AS op, '{_LABEL[op]}' AS label, {at} AS changed_at, {before} AS before, {after} AS after "
        f"FROM {given} WHERE {applies}"
        for op, applies, at, before, after in versions
    ]
    return " UNION ALL ".join(parts)


TABLES: dict[str, str] = {
    "ue_k": f"SELECT {_cols(dt.USER_EVENTS)}, k FROM {_events_k()}",
    "user_events": f"""SELECT * EXCLUDE (k), event_timestamp + interval '1' second * k AS ingested_at FROM ue_k
        UNION ALL SELECT * EXCLUDE (k), event_timestamp + interval '1' second * (k + 3600) FROM ue_k
        WHERE {dt.REDELIVERED}""",
    "user_events_once": "SELECT * EXCLUDE (k), event_timestamp + interval '1' second * k AS ingested_at FROM ue_k",
    "raw_messages": f"SELECT *, {dt.RAW_MESSAGE} AS value FROM ue_k",
    "pe_k": f"SELECT {_cols(dt.PAY_EVENTS)}, k FROM {_events_k()}",
    "raw_pay_messages": f"SELECT *, {dt.RAW_PAY_MESSAGE} AS value FROM pe_k",
    "pay_events": "SELECT * EXCLUDE (k) FROM pe_k",
    "s_orders": f"SELECT {_cols(dt.ORDERS)} FROM orders",
    "s_items": f"SELECT {_cols(dt.ORDER_ITEMS)} FROM lineitem",
    "s_products": f"SELECT {_cols(dt.PRODUCTS)} FROM part",
    # payment chain shared by many checks
    # an event is its earliest delivery: one row per id, taken in order of arrival
    "stg_events": """
        WITH parts AS (SELECT *, string_split(event_name, '.') AS words FROM pay_events),
        kept AS (SELECT * FROM parts
            WHERE len(words) = 3 AND len(list_filter(words, lambda w: regexp_full_match(w, '[a-z_]+'))) = 3
              AND NOT regexp_matches(user_id, '^(test|internal).')
              AND datediff('day', CAST(event_timestamp AS DATE), DATE '2024-01-31') <= 90)
        SELECT DISTINCT ON (event_id) * EXCLUDE (words), words[1] AS event_category, words[2] AS event_action,
            words[3] AS event_label
        FROM kept ORDER BY event_id, _ingested_at, event_timestamp, session_id, event_name""",
    # payments and transfers as one list of moves; the earliest of a move and event name; status from a rule table
    "stg_transactions": """
        WITH statuses(kind, pattern, turn, status) AS (VALUES
            ('payment', 'payment.complete.payment_success', 1, 'COMPLETED'),
            ('payment', 'payment.complete.refund', 2, 'REFUNDED'), ('payment', 'payment.fail.payment_error', 3, 'FAILED'),
            ('transfer', '%complete%', 1, 'COMPLETED'), ('transfer', '%fail%', 2, 'FAILED')),
        moves AS (
            SELECT event_category AS kind, CASE event_category WHEN 'payment' THEN transaction_id ELSE transfer_id END AS id,
                e AS event FROM stg_events AS e WHERE event_category IN ('payment', 'transfer')),
        earliest AS (
            SELECT kind, id, arg_min(event, (event.event_timestamp, event.event_id)) AS e FROM moves
            WHERE id IS NOT NULL GROUP BY kind, id, event.event_name)
        SELECT e.event_timestamp, e.user_id, e.session_id, id AS transaction_id, e.amount,
            if(kind = 'payment', e.payment_method, 'transfer') AS payment_method,
            if(kind = 'payment', e.merchant_id, NULL) AS merchant_id,
            if(kind = 'payment', e.merchant_category, NULL) AS merchant_category,
            if(kind = 'payment', e.is_first_payment, false) AS is_first_payment, e.event_name,
            coalesce((SELECT arg_min(s.status, s.turn) FROM statuses AS s
                WHERE s.kind = earliest.kind AND earliest.e.event_name LIKE s.pattern), 'UNKNOWN') AS transaction_status
        FROM earliest WHERE e.amount > 0""",
    # flags come from a list of conditions joined to the events
    "int_user_sessions": """
        WITH steps(flag, category, action, name) AS (VALUES
            ('has_login', NULL, NULL, 'auth.complete.login'), ('has_payment_view', 'payment', 'view', NULL),
            ('has_method_select', NULL, NULL, 'payment.click.payment_method_select'),
            ('has_payment_submit', NULL, NULL, 'payment.submit.payment_request'),
            ('has_payment_complete', NULL, NULL, 'payment.complete.payment_success'),
            ('has_payment_fail', 'payment', 'fail', NULL), ('has_transfer_view', 'transfer', 'view', NULL),
            ('has_transfer_complete', NULL, NULL, 'transfer.complete.to_account'), ('has_error', 'error', NULL, NULL)),
        spans AS (SELECT session_id, user_id, device_type, min(event_timestamp) AS session_start,
            max(event_timestamp) AS session_end, count(*) AS total_events FROM stg_events GROUP BY ALL),
        reached AS (SELECT session_id, user_id, device_type, list(DISTINCT flag) AS flags FROM stg_events JOIN steps
            ON event_category = coalesce(category, event_category) AND event_action = coalesce(action, event_action)
            AND event_name = coalesce(name, event_name) GROUP BY ALL)
        SELECT s.session_id, s.user_id, s.device_type, session_start, session_end,
            (epoch_us(session_end) - epoch_us(session_start)) // 1000000 AS session_duration_sec, total_events, """
    + ", ".join(
        f"CAST(coalesce(list_contains(flags, '{flag}'), false) AS INTEGER) AS {flag}"
        for flag in (
            "has_login has_payment_view has_method_select has_payment_submit has_payment_complete has_payment_fail "
            "has_transfer_view has_transfer_complete has_error"
        ).split()
    )
    + """ FROM spans AS s LEFT JOIN reached AS r ON s.session_id IS NOT DISTINCT FROM r.session_id
            AND s.user_id IS NOT DISTINCT FROM r.user_id AND s.device_type IS NOT DISTINCT FROM r.device_type""",
    "logins": """SELECT DISTINCT user_id, CAST(event_timestamp AS DATE) AS d FROM stg_events
        WHERE event_name = 'auth.complete.login' AND user_id NOT LIKE 'anonymous_%'""",
    "cohorts": "SELECT user_id, min(d) AS cohort_date FROM logins GROUP BY 1",
    **{f"v_{t}": _versions(t) for t in dt.CHANGES},
    **{
        f"msg_{t}": f"""SELECT '{{"before":' || coalesce(before, 'null') || ',"after":' || coalesce(after, 'null')
        || ',"source":{{"table":"{t}","db":"shop"}},"op":"' || op || '","ts_ms":'
        || cast(epoch_ms(changed_at) as string) || '}}' AS value FROM v_{t}"""
        for t in dt.CHANGES
    },
    **{
        f"cdc_{t}": f"""SELECT '{t}' AS cdc_table, label AS cdc_operation, changed_at AS cdc_timestamp,
        before AS before_data, after AS after_data, coalesce(after, before, '{{}}') AS raw_payload,
        changed_at AS ingested_at FROM v_{t}"""
        for t in dt.CHANGES
    },
}

_ORDER = list(TABLES)


def with_tables(body: str) -> str:
    """Prefix a query with the table expressions it needs, directly or through others."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in _ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(TABLES[name])
    if not needed:
        return body
    # a table may use one that is stated later, so order by dependency
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for other in _ORDER:
            if other != name and re.search(rf"\b{other}\b", TABLES[name]):
                visit(other)
        done.append(name)

    for name in _ORDER:
        if name in needed:
            visit(name)
    ctes = ", ".join(f"{name} AS ({TABLES[name]})" for name in done)
    stripped = body.strip()
    if re.match(r"(?i)with\b", stripped):
        return f"WITH {ctes}, {stripped[4:].strip()}"
    return f"WITH {ctes} {stripped}"
