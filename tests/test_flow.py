"""Streams against their batch form, replay, late data, and the layered tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemill.operators import changes, checks
from tidemill.operators import collect as k
from tidemill.plans import daily
from tidemill.plans.lake import Lake
from tidemill.sources import driver_tables as t
from tidemill.sources.tables import source_events_file
from tidemill.streaming import jobs, sinks, sources


def _event(i, session, ts, kind="page_view", **more):
    return json.dumps(
        {"event_id": f"event-{i:05d}", "event_type": kind, "session_id": session, "device_type": "ios", "event_timestamp": ts, **more}
    )


def _write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_sessions_drop_late_rows(spark, tmp_path):
    src = tmp_path / "in"
    first = [
        _event(1, "s1", "2024-01-01T00:00:10Z"), _event(2, "s1", "2024-01-01T00:00:50Z", "purchase"),
        _event(3, "s1", "2024-01-01T00:01:00Z"), _event(4, "s2", "2024-01-01T01:00:00Z"),
    ]
    _write(src, "a.txt", first)
    args = (f"{tmp_path}/out", f"{tmp_path}/cp")

    def run():
        messages = sources.source_events_stream(spark, str(src), "text", {"maxFilesPerTrigger": "1"})
        jobs.aggregate_sessions(messages, *args).awaitTermination()

    run()
    _write(src, "b.txt", [_event(5, "s1", "2024-01-01T00:00:20Z"), _event(6, "s3", "2024-01-01T03:00:00Z")])
    run()
    out = spark.read.parquet(args[0]).orderBy("window_start").collect()
    got = [(r.session_id, r.event_count, r.has_purchase, r.window_start.strftime("%H:%M")) for r in out]
    assert got == [("s1", 2, True, "00:00"), ("s1", 1, False, "00:01"), ("s2", 1, False, "01:00")]


def test_ingest_splits_and_continues_from_the_checkpoint(spark, tmp_path):
    src = tmp_path / "in"
    _write(src, "a.txt", [_event(1, "s1", "2024-01-01T00:00:10Z"), "broken", '{"event_id": "x"}'])
    paths = [f"{tmp_path}/{n}" for n in ("events", "dead", "cp")]
    for name, lines in ((None, None), ("b.txt", [_event(2, "s2", "2024-01-02T00:00:10Z")])):
        if name:
            _write(src, name, lines)
        jobs.ingest_events(sources.source_events_stream(spark, str(src), "text"), *paths).awaitTermination()
    events = spark.read.parquet(paths[0])
    assert sorted(r.event_id for r in events.collect()) == ["event-00001", "event-00002"]
    assert {str(r.event_date) for r in events.select("event_date").collect()} == {"2024-01-01", "2024-01-02"}
    assert sorted(r.raw_data for r in spark.read.parquet(paths[1]).collect()) == ["broken", '{"event_id": "x"}']


def test_replayed_batch_replaces_itself(spark, sf, tmp_path):
    rows = t.changes(spark, sf, "users")
    first = {r.cdc_table: r.rows_written for r in sinks.sink_cdc_fanout(rows, 7, f"{tmp_path}/cdc").collect()}
    again = {r.cdc_table: r.rows_written for r in sinks.sink_cdc_fanout(rows, 7, f"{tmp_path}/cdc").collect()}
    assert first == again == {"users": rows.count()}
    sinks.sink_cdc_fanout(rows, 8, f"{tmp_path}/cdc")
    assert spark.read.parquet(f"{tmp_path}/cdc").count() == 2 * rows.count()


def test_closed_dates_are_compacted(spark, sf, tmp_path):
    rows = t.changes(spark, sf, "users")
    for batch in range(3):
        sinks.sink_cdc_fanout(rows, batch, f"{tmp_path}/cdc", date_unit="year")
    dates = spark.read.parquet(f"{tmp_path}/cdc").select("cdc_date").distinct().count()
    assert sinks.compact_batches(spark, f"{tmp_path}/cdc", "2100-01-01") == dates
    stored = spark.read.parquet(f"{tmp_path}/cdc")
    assert stored.count() == 3 * rows.count() and [r[0] for r in stored.select("batch_id").distinct().collect()] == [-1]
    assert sinks.compact_batches(spark, f"{tmp_path}/cdc", "2100-01-01") == 0


def test_stream_dedup_within_watermark(spark, tmp_path):
    src = tmp_path / "in"
    _write(src, "a.txt", [_event(1, "s", "2024-01-01T00:00:10Z"), _event(1, "s", "2024-01-01T00:00:10Z")])
    _write(src, "b.txt", [_event(1, "s", "2024-01-01T00:00:10Z"), _event(2, "s", "2024-01-01T00:00:11Z")])
    messages = sources.source_events_stream(spark, str(src), "text", {"maxFilesPerTrigger": "1"})
    events = jobs.dedup_delivery(k.enrich_events(k.parse_events(messages)[0])).select("event_id")
    sinks.sink_session_aggs(events, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["event-00001", "event-00002"]


def test_sliding_searches_equal_batch(spark, sf, tmp_path):
    events = k.enrich_events(t.user_events_of(t.stream_of(spark, sf, "events")))
    stream = jobs.trending_search_stream(events, min_count=1)
    sinks.sink_session_aggs(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    batch = jobs.trending_search_stream(k.enrich_events(t.user_events(spark, sf)), min_count=1)
    last = got.agg(F.max("window_start")).first()[0]
    assert got.count() == batch.filter(F.col("window_start") <= F.lit(last)).count()
    assert got.exceptAll(batch).count() == 0


def test_event_files_in_both_formats(spark, tmp_path):
    rows = [_event(i, "s", "2024-01-01T00:00:10Z") for i in range(3)]
    _write(tmp_path / "lines", "a.json", rows)
    _write(tmp_path / "array", "a.json", ["[", ",\n".join(rows), "]"])
    assert source_events_file(spark, f"{tmp_path}/lines").count() == 3
    assert source_events_file(spark, f"{tmp_path}/array", multiline=True).count() == 3


def test_full_refresh_removes_old_partitions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.range(10).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) as d")
    lake.ctas_replace(df, "mart", "x", "d", ("id",))
    lake.ctas_replace(df.filter("d = date'2024-01-01'"), "mart", "x", "d", ("id",))
    assert lake.read("mart", "x").count() == 4


def test_write_dispositions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows, seconds, size = lake.run_query_to_table("select :n as n", "mart", "q", {"n": 3})
    assert rows == 1 and seconds > 0 and size == lake.stored_bytes("mart", "q") > 0
    added = lake.run_query_to_table("select :n as n", "mart", "q", {"n": 4}, "append")[2]
    assert lake.stored_bytes("mart", "q") == size + added
    assert sorted(r.n for r in lake.read("mart", "q").collect()) == [3, 4]
    with pytest.raises(Exception, match="(?i)already exists"):
        lake.run_query_to_table("select 1 as n", "mart", "q", disposition="empty")


def test_bootstrap_is_idempotent(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.bootstrap_layers().count() == 15
    assert lake.bootstrap_layers().count() == 0
    assert lake.read("staging", "orders").count() == 0


def test_gate_stops_the_payment_job(spark, sf, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(daily.QualityGateFailure):
        daily.run_payment_metrics(lake, t.pay_events(spark, sf), t.EVENTS_AS_OF)
    assert not lake.exists("mart", "mart_revenue")
    log = lake.read("monitoring", "run_log").collect()
    assert {r.status for r in log if r.table_name != "quality_gate"} == {"success"}
    assert [r.status for r in log if r.table_name == "quality_gate"] == ["error"]


def test_bad_times_do_not_drop_later_events(spark, tmp_path):
    src = tmp_path / "in"
    for i, (name, day) in enumerate((("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5))):
        lines = [_event(i, f"s{day}", f"2024-01-0{day}T00:00:10Z")]
        if name == "a":
            lines += [_event(90, "bad", "bad"), _event(91, "ahead", "2124-01-01T00:00:00Z")]
        _write(src, f"{name}.txt", lines)
        os.utime(src / f"{name}.txt", (1_700_000_000 + 60 * i,) * 2)  # files are read in order of their times
    options = {"maxFilesPerTrigger": "1"}
    messages = sources.source_events_stream(spark, str(src), "text", options)
    jobs.aggregate_sessions(messages, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    sessions = {r.session_id for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert sessions == {"s1", "s2", "s3", "s4"}
    messages = sources.source_events_stream(spark, str(src), "text", options)
    jobs.store_untimed(messages, f"{tmp_path}/rest", f"{tmp_path}/cp2").awaitTermination()
    assert {r.session_id for r in spark.read.parquet(f"{tmp_path}/rest").collect()} == {"bad", "ahead"}


def test_retention_looks_at_the_last_day_of_a_folder(spark, tmp_path):
    days = spark.range(62).selectExpr("id", "cast(date_add(date'2023-12-01', cast(id as int)) as timestamp) as event_timestamp")
    lake = Lake(spark, str(tmp_path), date_unit="month")
    months = days.withColumn("event_date", F.to_date(F.date_trunc("month", "event_timestamp")))
    lake.ctas_replace(months, "raw", "user_events", "event_date")
    dropped = lake.expire_raw_partitions("user_events", "2024-01-16", days=10)
    assert [str(r.partition_date) for r in dropped.collect()] == ["2023-12-01"]
    assert lake.read("raw", "user_events").count() == 26
    rows = days.selectExpr("'orders' as cdc_table", "to_date(event_timestamp) as cdc_date", "event_timestamp as cdc_timestamp")
    rows.write.partitionBy("cdc_table", "cdc_date").parquet(f"{tmp_path}/raw/changes")
    assert lake.expire_raw_partitions("changes", "2024-01-16", days=10, unit="day").count() == 36
    assert spark.read.parquet(f"{tmp_path}/raw/changes").count() == 26


def test_changes_without_a_key_are_reported(spark, sf):
    good = t.changes(spark, sf, "users")
    bad = good.limit(2).withColumn("after_data", F.lit("{broken")).withColumn("before_data", F.lit(None).cast("string"))
    both = good.unionByName(bad)
    assert changes.without_key(both, "user_id").count() == 2
    state = changes.latest_state(both, "user_id", changes.USER_FIELDS, quarantine=True)
    assert state.count() == changes.stg_users(good).count() and state.filter("user_id IS NULL").count() == 0
    assert changes.stg_users(both).filter("user_id IS NULL").count() == 1


def test_empty_documents(spark):
    texts = ["{}", " { } ", "{\n}", '{"a":1}', "", None]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    kept = frame.withColumn("d", changes._document(F.col("x"))).filter("d IS NOT NULL").collect()
    assert [r.i for r in kept] == [3, 4]


def test_quality_job_stores_before_it_stops(spark, sf, tmp_path):
    lake = Lake(spark, str(tmp_path))
    checks_frame = spark.createDataFrame(
        [("freshness", "t", "FAIL", 90.0, 30.0, "late", "2024-01-31 00:00:00")],
        "check_name string, table_name string, status string, metric_value double, threshold double, details string, at string",
    ).withColumn("checked_at", F.to_timestamp("at")).drop("at")
    with pytest.raises(checks.CriticalQualityFailure):
        daily.run_quality_checks(lake, checks_frame)
    assert lake.read("monitoring", "data_quality_checks").count() == 1
    assert {r.status for r in lake.read("monitoring", "run_log").collect()} == {"success", "error"}
    fine = checks_frame.withColumn("status", F.lit("PASS"))
    daily.run_quality_checks(lake, fine)
    assert lake.read("monitoring", "data_quality_checks").count() == 2


def _stopped_after(steps, n):
    """Runs the first n steps; whether there was another one."""
    for k, _ in enumerate(steps, 1):
        if k == n:
            return True
    return False


@pytest.mark.parametrize("dated", [True, False])
def test_a_merge_stopped_after_any_step_keeps_every_row(spark, tmp_path, dated):
    n, more = 0, True
    while more:
        n += 1
        path = f"{tmp_path}/{n}"
        for batch in range(3):
            rows = spark.range(batch * 10, batch * 10 + 5).withColumn("cdc_date", F.lit("2024-01-01"))
            sinks.write_batch(rows, path, batch, ("cdc_date",) if dated else ())
        root, fs = sinks.filesystem(spark, f"{path}/cdc_date=2024-01-01" if dated else path)
        more = _stopped_after(sinks.merge_steps(spark, fs, root, sinks._batches(fs, root)), n)
        if n % 2:
            found = sinks.read_batches(spark, path)
        elif dated:
            sinks.compact_batches(spark, path, "2100-01-01")
            found = spark.read.parquet(path)
        else:
            sinks.compact_dead_letters(spark, path, 2)
            found = spark.read.parquet(path)
        assert sorted(r.id for r in found.collect()) == sorted(b * 10 + k for b in range(3) for k in range(5))
        # what was merged can be merged again with what came later
        sinks.write_batch(spark.range(90, 92).withColumn("cdc_date", F.lit("2024-01-01")), path, 7, ("cdc_date",) if dated else ())
        sinks.compact_batches(spark, path, "2100-01-01") if dated else sinks.compact_dead_letters(spark, path, 8)
        assert sinks.read_batches(spark, path).count() == 17
        assert len(sinks._batches(fs, root)) == 1
    assert n > 6


def test_an_expiry_stopped_after_any_step_keeps_every_row(spark, tmp_path):
    rows = spark.range(40).selectExpr("id", "timestamp_seconds(1704067200 + id * 86400) as event_timestamp")
    rows = rows.withColumn("event_date", F.to_date(F.date_trunc("month", "event_timestamp")))
    n, more = 0, True
    while more:
        n += 1
        lake = Lake(spark, f"{tmp_path}/{n}", date_unit="month")
        lake.ctas_replace(rows, "raw", "readings", "event_date")
        fs, path = lake._fs(lake.path("raw", "readings") + "/event_date=2024-01-01")
        kept = spark.read.parquet(path.toString()).filter("id >= 10")
        more = _stopped_after(lake._cut_steps(fs, path, kept), n)
        assert lake.read("raw", "readings").schema["event_date"].dataType.simpleString() == "date"
        lake.expire_raw_partitions("readings", "2024-01-21", days=10)
        assert sorted(r.id for r in lake.read("raw", "readings").collect()) == list(range(10, 40))
    assert n == 5
