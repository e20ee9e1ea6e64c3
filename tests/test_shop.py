import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tidemill.functions.keyed import join_dimension, next_in_group, rolling_distinct
from tidemill.operators import behaviour as b
from tidemill.operators import sales as s
from tidemill.operators import staging as st


def test_order_amount_counts_per_item_unless_exact(spark):
    orders = spark.createDataFrame(
        [(1, 7, "DELIVERED", 100.0, "DAWN", dt.datetime(2024, 1, 6)), (2, 7, "CANCELLED", 50.0, "DAWN", dt.datetime(2024, 1, 6))],
        "order_id bigint, user_id bigint, order_status string, total_amount double, delivery_type string, ordered_at timestamp",
    )
    items = spark.createDataFrame([(1, 1, 2, 60.0), (1, 2, 1, 40.0)], "order_id bigint, product_id bigint, quantity bigint, subtotal double")
    products = spark.createDataFrame([(1, "c", "x"), (2, "c", "x")], "product_id bigint, category_l1 string, storage_type string")
    loose = {r.category_l1: r for r in s.mart_daily_sales(orders, items, products).collect()}
    exact = {r.category_l1: r for r in s.mart_daily_sales(orders, items, products, exact=True).collect()}
    assert (loose["c"].total_revenue, exact["c"].total_revenue) == (200.0, 100.0)
    assert loose["c"].total_items_sold == 3 and loose["c"].avg_order_value == 100.0
    assert loose[None].order_count == 1 and loose[None].cancellation_rate == 1.0


def test_weeks_start_on_sunday(spark):
    orders = spark.createDataFrame(
        [(1, 1, "NEW", dt.datetime(2024, 1, 7)), (2, 1, "NEW", dt.datetime(2024, 1, 6))],
        "order_id bigint, user_id bigint, order_status string, ordered_at timestamp",
    )
    items = spark.createDataFrame([(1, 1, 1, 5.0), (2, 1, 1, 6.0)], "order_id bigint, product_id bigint, quantity bigint, subtotal double")
    products = spark.createDataFrame([(1, "c", "x")], "product_id bigint, category_l1 string, storage_type string")
    out = s.category_sales_weekly(orders, items, products, "2024-02-01").collect()
    assert [r.week_start.isoformat() for r in out] == ["2024-01-07", "2023-12-31"]


def test_staging_keeps_latest_delivery(spark):
    cols = "event_id string, event_type string, event_timestamp timestamp, user_id bigint, session_id string, device_type string, page_url string, referrer string, utm_source string, utm_medium string, utm_campaign string, properties string, ingested_at timestamp"
    t0 = dt.datetime(2024, 1, 1)
    row = ("e", "page_view", t0, 1, "s", "ios", None, None, None, None, None, "{}")
    df = spark.createDataFrame([(*row, t0), (*row, t0 + dt.timedelta(hours=1))], cols)
    assert st.stg_user_events(df).first().ingested_at.hour == 1
    assert st.stg_user_events(df).count() == 1
    assert st.stg_user_events_distinct(df).count() == 2


def _random_events(n, hot_share=0.34, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        session = "hot" if rng.random() < hot_share else f"s{rng.randrange(40)}"
        second = rng.randrange(0, 86400)
        rows.append((f"e{i:06d}", session, rng.choice(b.FUNNEL), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)))
    return rows


def test_transitions_with_a_hot_session_match_brute_force(spark):
    rows = _random_events(3000)
    expected = Counter()
    by_session = {}
    for event_id, session, kind, ts in rows:
        by_session.setdefault(session, []).append((ts, event_id, kind))
    for events in by_session.values():
        events.sort()
        for a, c in zip(events, events[1:]):
            expected[(a[2], c[2])] += 1
    df = spark.createDataFrame(rows, "event_id string, session_id string, event_type string, event_timestamp timestamp")
    for width in ("10 minutes", "1 minute", "1 day"):
        moves = next_in_group(df, "session_id", "event_timestamp", "event_id", ["event_type"], width)
        got = {(r.event_type, r.next_event_type): r.n for r in moves.groupBy("event_type", "next_event_type").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert got == dict(expected)


def test_rolling_distinct_matches_brute_force(spark):
    rng = random.Random(2)
    days = sorted({(f"u{rng.randrange(30)}", rng.randrange(60)) for _ in range(400)})
    start = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(u, start + dt.timedelta(days=d)) for u, d in days], "user_id string, dt date")
    got = {(r.dt - start).days: (r.daily_distinct, r.w, r.m) for r in rolling_distinct(df, "user_id", "dt", {"w": 7, "m": 30}).collect()}
    for d in {d for _, d in days}:
        within = lambda n: len({u for u, x in days if d - n < x <= d})
        assert got[d] == (within(1), within(7), within(30))


def test_salted_join_equals_plain_join(spark):
    facts = spark.createDataFrame([(i, 1 if i % 3 == 0 else i % 7, float(i)) for i in range(500)], "id bigint, k bigint, v double")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k bigint, name string")
    for how in ("left", "inner"):
        plain = facts.join(dim, "k", how).select("id", "name").collect()
        salted = join_dimension(facts, dim, "k", how).select("id", "name").collect()
        assert sorted(map(str, plain)) == sorted(map(str, salted))
