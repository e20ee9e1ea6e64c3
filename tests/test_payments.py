import datetime as dt

from pyspark.sql import functions as F

from tidemill.operators import engagement as g
from tidemill.operators import payments as p
from tidemill.operators import staging as st
from tidemill.schemas import PAYMENT_EVENTS

AS_OF = "2024-03-31"


def pay(spark, rows):
    """rows: dicts over the payment event columns; property names may be given flat."""
    props = [f.name for f in PAYMENT_EVENTS["properties"].dataType.fields]
    out = []
    for i, r in enumerate(rows):
        ts = dt.datetime.fromisoformat(r.get("ts", "2024-03-01 00:00:00"))
        out.append(
            (
                r.get("event_id", f"e{i}"), r["event_name"], ts, r.get("user_id", "user_1"), r.get("session_id", "s1"),
                "d", r.get("device_type", "ios"), "1.0.0", None, None, tuple(r.get(n) for n in props),
                dt.datetime.fromisoformat(r["seen"]) if "seen" in r else ts,
            )
        )
    return spark.createDataFrame(out, PAYMENT_EVENTS)


def success(txn, amount, **more):
    return {"event_name": "payment.complete.payment_success", "transaction_id": txn, "amount": amount, **more}


def refund(txn, amount, **more):
    return {"event_name": "payment.complete.refund", "transaction_id": txn, "amount": amount, **more}


def login(user, day, **more):
    return {"event_name": "auth.complete.login", "user_id": user, "ts": f"{day} 08:00:00", **more}


def staged(spark, rows):
    return st.stg_events(pay(spark, rows), AS_OF)


def test_staging_filters_users_and_keeps_earliest(spark):
    rows = [
        login("test_1", "2024-03-01"), login("testX1", "2024-03-01"), login(None, "2024-03-01"),
        login("anonymous_1", "2024-03-01"), login("user_1", "2023-01-01"),
        {"event_name": "PaymentSuccess"},
        login("user_2", "2024-03-02", event_id="dup", seen="2024-03-02 10:00:00"),
        login("user_2", "2024-03-03", event_id="dup", seen="2024-03-02 09:00:00"),
    ]
    rows[2]["user_id"] = None
    out = staged(spark, rows).collect()
    assert sorted((r.user_id, r.event_timestamp.day) for r in out) == [("anonymous_1", 1), ("user_2", 3)]


def test_amount_is_tested_after_the_first_row_is_chosen(spark):
    rows = [success("t1", 0, ts="2024-03-01 00:00:00"), success("t1", 100, ts="2024-03-01 00:01:00"), success("t2", 5)]
    out = st.stg_transactions(staged(spark, rows)).collect()
    assert [r.transaction_id for r in out] == ["t2"]


def test_payment_and_transfer_ids_do_not_collide(spark):
    rows = [success("x", 5), {"event_name": "transfer.complete.to_account", "transfer_id": "x", "amount": 7}]
    out = st.stg_transactions(staged(spark, rows)).orderBy("amount").collect()
    assert [(r.payment_method, r.transaction_status) for r in out] == [(None, "COMPLETED"), ("transfer", "COMPLETED")]


def test_arppu_sums_refunds_before_deducting(spark):
    rows = [
        success("a", 100, payment_method="card"), refund("a", 30), refund("a", 20),
        success("b", 40, user_id="user_2"), refund("b", 40), success("c", 60, user_id="user_2"),
    ]
    row = p.arppu_daily(staged(spark, rows)).first()
    assert (row.paying_users, row.gross_revenue, row.total_refunds, row.net_revenue) == (2, 160, 50, 110)
    assert row.card_pct == 50.0


def test_mart_revenue_nets_and_excludes(spark):
    df = staged(spark, [success("a", 100, payment_method="card", merchant_category="m1"), success("n", 70), success("r", 10, payment_method="card")])
    txns = st.stg_transactions(df)
    back = txns.filter("transaction_id = 'a'").withColumn("transaction_status", F.lit("REFUNDED"))
    more = back.withColumn("amount", F.lit(30).cast("bigint")).unionByName(back.withColumn("amount", F.lit(20).cast("bigint")))
    full = txns.filter("transaction_id = 'r'").withColumn("transaction_status", F.lit("REFUNDED"))
    row = p.mart_revenue(txns.unionByName(more).unionByName(full)).first()
    assert (row.total_transactions, row.gross_revenue, row.net_revenue) == (1, 100, 50)
    assert row.top_merchant_categories == '[{"merchant_category":"m1","net_amount":50}]'


def test_revenue_shares_use_all_net_rows(spark):
    rows = [
        success("a", 100, payment_method="card"), success("b", 10, payment_method="app_balance"), refund("b", 20),
        success("c", 5, ts="2024-03-05 00:00:00"),
    ]
    out = p.revenue_analysis(staged(spark, rows)).orderBy("dt").collect()
    assert round(out[0].card_revenue_pct, 4) == round(100 / 90 * 100, 4)
    assert out[0].revenue_change_pct is None
    assert out[1].revenue_change_pct == -95.0
    assert out[1].revenue_7d_ma == 52.5


def test_two_meanings_of_a_cohort(spark):
    rows = [login("user_1", "2024-01-21"), login("user_1", "2024-03-26"), login("user_2", "2024-03-26"), login("user_2", "2024-03-27")]
    events = staged(spark, rows)
    wide = g.retention_pivot(events, AS_OF, min_cohort=1).collect()
    assert [(r.cohort_date.isoformat(), r.cohort_size, r.d1) for r in wide] == [("2024-03-26", 2, 50.0)]
    long = g.retention_long(events, AS_OF).collect()
    assert {(r.cohort_date.isoformat(), r.day_n, r.cohort_users) for r in long} == {("2024-03-26", 0, 1), ("2024-03-26", 1, 1)}
    assert all(r.d1_retention == 100.0 for r in long)


def test_rolling_active_users(spark):
    rows = [login("user_1", "2024-03-01"), login("user_1", "2024-03-05"), login("user_2", "2024-03-09"), login("user_2", "2024-03-09", device_type="web")]
    events = staged(spark, rows)
    exact = {r.dt.day: r for r in g.active_users(events, AS_OF).collect()}
    assert {d: (r.dau, r.wau, r.mau) for d, r in exact.items()} == {1: (1, 1, 1), 5: (1, 1, 1), 9: (1, 2, 2)}
    assert (exact[9].dau_ios, exact[9].dau_web) == (1, 1)
    approx = {r.dt.day: (r.dau, r.wau, r.mau) for r in g.active_users(events, AS_OF, approx=True).collect()}
    assert approx == {d: (r.dau, r.wau, r.mau) for d, r in exact.items()}


def test_repeated_and_shuffled_input_changes_nothing(spark, sf):
    from tidemill.sources import driver_tables as t

    raw = t.pay_events(spark, sf)
    twice = raw.unionByName(raw).orderBy(F.rand(3))
    for build in (p.arppu_daily, p.revenue_analysis, lambda e: p.mart_revenue(st.stg_transactions(e))):
        once = build(st.stg_events(raw, "2024-01-31")).collect()
        again = build(st.stg_events(twice, "2024-01-31")).collect()
        assert sorted(map(str, once)) == sorted(map(str, again))


def test_login_days_merge_in_any_order(spark):
    days = ["2024-01-21", "2024-01-22", "2024-02-20", "2024-03-24", "2024-03-25", "2024-03-31"]
    rows = [login("user_1", d) for d in days] + [login("user_2", "2024-03-31"), login("user_2", "2024-03-31")]
    events = staged(spark, rows)
    whole = sorted(map(tuple, g.login_days(events).collect()))
    bits = sum(1 << n for n in (0, 1, 30))  # 63 days and more after the first one are not held
    assert [(u, d.isoformat(), b) for u, d, b in whole] == [("user_1", "2024-01-21", bits), ("user_2", "2024-03-31", 1)]
    parts = [g.login_days(events.filter(F.to_date("event_timestamp") == d)) for d in (days[3], days[0], days[5], days[2], days[1], days[4], days[0])]
    state = parts[0]
    for part in parts[1:]:
        state = g.merge_login_days(state, part)
    assert sorted(map(tuple, state.collect())) == whole
    assert sorted(map(tuple, g.merge_login_days(*parts).collect())) == whole
    assert g.merge_login_days(g.login_days(events.limit(0))).count() == 0
    expected = g.mart_user_retention(events, AS_OF, cohort_days=90).collect()
    assert sorted(map(tuple, g.retention_of_login_days(state, AS_OF, cohort_days=90).collect())) == sorted(map(tuple, expected))
