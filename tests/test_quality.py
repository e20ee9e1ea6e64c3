import datetime as dt

import pytest

from tidemill import schemas
from tidemill.operators import alerts as a
from tidemill.operators import checks as q
from tidemill.operators import payments as p
from tidemill.operators import rules as r

AT = "2024-01-31 00:00:00"


def _ingested(spark, minutes):
    stamps = [(dt.datetime(2024, 1, 31) - dt.timedelta(minutes=m),) for m in minutes]
    return spark.createDataFrame(stamps, "ingested_at timestamp")


@pytest.mark.parametrize("minutes, status", [(24, "PASS"), (25, "WARN"), (30, "WARN"), (31, "FAIL"), (None, "FAIL")])
def test_freshness_levels(spark, minutes, status):
    df = _ingested(spark, [] if minutes is None else [minutes, minutes + 100])
    row = q.dq_freshness(df, "t", AT, 30).first()
    assert row.status == status and row.metric_value == minutes


def _days(spark, counts, last="2024-01-30"):
    end = dt.date.fromisoformat(last)
    rows = [
        (dt.datetime.combine(end - dt.timedelta(days=i), dt.time(12)),) for i, n in enumerate(counts) for _ in range(n)
    ]
    return spark.createDataFrame(rows, "event_timestamp timestamp")


def test_volume_of_equal_days_passes(spark):
    row = q.dq_volume_zscore(_days(spark, [3] * 13), "t", "2024-01-31").first()
    assert (row.status, row.metric_value) == ("PASS", 0.0)


def test_volume_spike_and_missing_day(spark):
    spike = _days(spark, [60] + [3, 4] * 6)
    assert q.dq_volume_zscore(spike, "t", "2024-01-31").first().status == "FAIL"
    alone = q.dq_volume_zscore(spike, "t", "2024-01-31", exclude_tested_day=True).first()
    assert alone.metric_value > 50
    assert q.dq_volume_zscore(_days(spark, [3] * 5, "2024-01-20"), "t", "2024-01-31").first().status == "WARN"


def test_null_and_duplicate_rates(spark):
    t0 = dt.datetime(2024, 1, 30, 5)
    df = spark.createDataFrame([("a", 1, t0), ("a", None, t0), ("b", 2, t0)], "k string, v int, event_timestamp timestamp")
    rates = {x.check_name: x for x in q.dq_null_rates(df, "t", ("k", "v"), "2024-01-30").collect()}
    assert rates["null_rate_k"].status == "PASS" and rates["null_rate_v"].status == "FAIL"
    assert "33.33%" in rates["null_rate_v"].details
    assert q.dq_duplicate_rate(df, "t", "k", "2024-01-30").first().status == "FAIL"
    assert {x.status for x in q.dq_null_rates(df, "t", ("k",), "2024-01-01").collect()} == {"WARN"}
    assert q.dq_duplicate_rate(df, "t", "k", "2024-01-01").first().status == "WARN"


def test_critical_failure_raises(spark):
    stale = q.dq_freshness(_ingested(spark, [99]), "t", AT)
    with pytest.raises(q.CriticalQualityFailure):
        q.raise_on_critical(stale)
    q.raise_on_critical(q.dq_freshness(_ingested(spark, [1]), "t", AT))


def test_rules(spark):
    df = spark.createDataFrame(
        [("TXN-AAAAAAAA", 5, "card"), ("TXN-AAAAAAAA", 0, "cash"), (None, None, None), ("bad", 10, "card")],
        "id string, amount int, method string",
    )
    rules = [
        r.expect_not_null("id"), r.expect_match_regex("id", "^TXN-[A-Z]{8}$"), r.expect_in_set("method", ["card"]),
        r.expect_between("amount", 0, None, strict_low=True), r.expect_between("amount", 0, 100), r.expect_unique("id"),
        r.expect_row_count(1, 4), r.expect_unique_proportion("id", 0.5, 1.0), r.expect_mean("amount", 4, 6),
    ]
    rows = r.dq_suite_run(df, rules, "s").orderBy("rule_no").collect()
    assert [x.success for x in rows] == [False, False, False, False, True, False, True, True, True]
    assert [x.unexpected_count for x in rows] == [1, 1, 1, 1, 0, 2, None, None, None]
    assert rows[1].unexpected_percent == pytest.approx(100 / 3)


def test_mostly_tolerates_one_percent(spark):
    df = spark.range(100).selectExpr("case when id = 0 then -1 else id end as v")
    rows = r.dq_suite_run(df, [r.expect_between("v", 0, 1000, mostly=0.99), r.expect_between("v", 0, 1000)], "s").collect()
    assert [x.success for x in rows] == [True, False]


def test_pair_rule_uses_users(spark):
    events = spark.createDataFrame([("e1", 1, dt.datetime(2024, 1, 2)), ("e2", 1, dt.datetime(2023, 1, 1)), ("e3", 9, dt.datetime(2023, 1, 1))], "event_id string, user_id bigint, event_timestamp timestamp")
    users = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "user_id bigint, created_at timestamp")
    df = r.with_user_created_at(events, users)
    row = r.dq_suite_run(df, [r.expect_pair_a_ge_b("event_timestamp", "user_created_at")], "s").first()
    assert (row.unexpected_count, row.unexpected_percent) == (1, 50.0)


def _results(spark, *rows):
    return spark.createDataFrame(
        [(s, i, "not_null", "c", p_, cat, None, 10, 1, pct, ok) for i, (s, p_, cat, pct, ok) in enumerate(rows)],
        "suite string, rule_no int, expectation string, column string, priority string, category string, "
        "observed_value double, element_count bigint, unexpected_count bigint, unexpected_percent double, success boolean",
    )


def test_routing_halts_only_for_the_first_priority(spark):
    soft = _results(spark, ("a", "P2", "x", 5.0, False), ("a", "P1", "x", 5.0, False), ("a", "P0", "x", 0.0, True))
    assert {(f.max_priority, f.channel, f.should_halt) for f in a.dq_failures(soft).collect()} == {("P1", "alerts", False)}
    assert not a.should_halt(soft)
    hard = _results(spark, ("a", "P0", "x", 2.0, False), ("a", "P1", "x", 0.1, False), ("b", "P2", "x", 0.0, True))
    assert {f.max_priority for f in a.dq_failures(hard).collect()} == {"P0"}
    assert a.should_halt(hard)
    assert a.dq_daily_summary(hard).first() == (2, 1, 1, 2)
    assert a.dq_alert_branch(hard).first()[0] == "send_critical_alert"
    scores = {s.category: s.score for s in a.quality_scorecard(hard).collect()}
    assert scores["overall"] == pytest.approx((98 + 99.9 + 100) / 3)


def test_arppu_outlier(spark):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), 100.0 + i % 3) for i in range(29)] + [(dt.date(2024, 1, 30), 900.0)]
    mart = spark.createDataFrame(rows, "dt date, arppu double")
    assert p.check_arppu_reasonable(mart, "2024-01-31").first().arppu == 900.0
    calm = mart.filter("arppu < 200")
    assert p.check_arppu_reasonable(calm, "2024-01-30").count() == 0


def test_schema_drift(spark):
    df = spark.sql("select 'e' as event_id, 1 as extra, 'x' as user_id")
    drift = {x.column: x for x in q.schema_drift(df, schemas.RAW_USER_EVENTS).collect()}
    assert drift["extra"].expected is None and drift["extra"].filled_rows == 1
    assert drift["user_id"].expected == "bigint" and drift["user_id"].actual == "string"
    assert drift["session_id"].actual is None
    assert "event_id" not in drift
    same = spark.createDataFrame([], schemas.RAW_USER_EVENTS)
    assert q.schema_drift(same, schemas.RAW_USER_EVENTS).count() == 0


def test_gauges_and_alerts(spark):
    check = q.dq_freshness(_ingested(spark, [45]), "t", AT)
    gauges = {g.gauge: g.value for g in q.quality_gauges(check).collect()}
    assert gauges == {"data_quality_check_status": 0.0, "data_freshness_minutes": 45.0}
    log = spark.createDataFrame(
        [("job", "t", "success", 5, 1.0, None), ("job", "t", "error", 0, 1.0, "ValueError")],
        "pipeline_name string, table_name string, status string, rows_processed bigint, duration_sec double, error_type string",
    )
    fresh = spark.createDataFrame([("t", 31), ("u", 30)], "table_name string, freshness_minutes bigint")
    found = {(x.alert, x.severity, x.subject) for x in q.sla_alerts(q.run_counters(log), fresh).collect()}
    assert found == {("DataFreshnessSLABreach", "critical", "t"), ("PipelineExecutionFailed", "warning", "job")}
