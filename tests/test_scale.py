"""What keeps jobs within memory and time on large tables."""

import gzip
import json
import threading
from pathlib import Path

import pytest
from pyspark.sql import DataFrame

from tidemill.operators import changes as c
from tidemill.plans import daily, flow_queries
from tidemill.plans import lake as lake_module
from tidemill.plans.lake import Lake
from tidemill.sources import driver_tables as t
from tidemill.streaming import jobs, sinks, sources


def _envelope(i):
    return json.dumps({"before": None, "after": {"order_id": i}, "source": {"table": "orders"}, "op": "c", "ts_ms": 1000 * i})


def test_change_batches_are_not_held(spark, tmp_path, monkeypatch):
    def refuse(*args):
        raise AssertionError("a batch is held by executors")

    monkeypatch.setattr(DataFrame, "persist", refuse)
    lines = [_envelope(i) for i in range(5)]
    for name, texts in (("clean", lines), ("mixed", [*lines, "broken", "[1]"]), ("bad", ["broken"])):
        root = f"{tmp_path}/{name}"
        spark.createDataFrame([(x,) for x in texts], "value string").write.text(f"{root}/in")
        source = sources.source_cdc_stream(spark, f"{root}/in", "text")
        jobs.cdc_microbatch(source, f"{root}/out", f"{root}/dead", f"{root}/check", interval=None).awaitTermination()
        stored = list(Path(f"{root}/out").rglob("*.parquet"))
        assert (spark.read.parquet(f"{root}/out").count() if stored else 0) == sum(x in lines for x in texts)
        dead = list(Path(f"{root}/dead").rglob("*.parquet"))
        assert (spark.read.parquet(f"{root}/dead").count() if dead else 0) == sum(x not in lines for x in texts)


def test_event_batches_are_not_held(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(DataFrame, "persist", None)
    good = '{"event_id":"evt-00000001","event_type":"search","session_id":"s","event_timestamp":"2024-01-01T00:00:00Z"}'
    spark.createDataFrame([(good,), ("broken",), (good,)], "value string").write.text(f"{tmp_path}/in")
    source = sources.source_events_stream(spark, f"{tmp_path}/in", "text")
    jobs.ingest_events(source, f"{tmp_path}/out", f"{tmp_path}/dead", f"{tmp_path}/check").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    assert [r.raw_data for r in spark.read.parquet(f"{tmp_path}/dead").collect()] == ["broken"]


def test_change_tables_are_stored_small(spark, tmp_path):
    text = ",".join(f'"member{i}":"value"' for i in range(50))
    rows = spark.range(500).selectExpr(
        "'orders' cdc_table", "'INSERT' cdc_operation", "timestamp'2024-01-01' cdc_timestamp",
        f"concat('{{\"id\":', id, ',{text}}}') after_data", f"concat('{{\"id\":', id, ',{text}}}') raw_payload",
    )
    assert [tuple(r) for r in sinks.sink_cdc_fanout(rows, 0, f"{tmp_path}/cdc").collect()] == [("orders", 500)]
    files = list(Path(f"{tmp_path}/cdc").rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)
    assert spark.read.parquet(f"{tmp_path}/cdc").select("after_data").distinct().count() == 500


def test_drift_reads_a_form_once_and_counts_shapes(spark):
    rows = spark.createDataFrame(
        [("t", None, '{"a":1,"b":"x"}'), ("t", None, '{"a":2,"b":"y"}'), ("t", None, '{"a":"z"}'), ("t", None, None)],
        "cdc_table string, before_data string, after_data string",
    ).selectExpr("*", "timestamp'2024-01-01' cdc_timestamp")
    drift = c.document_drift(rows, {"t": {"a": ("a", "bigint"), "c": ("c", "string")}})
    found = {(r.member, r.problem, r.found_kinds, r.filled) for r in drift.collect()}
    assert found == {("a", "retyped", "text,whole", 3), ("b", "new", "text", 2), ("c", "missing", None, 0)}
    plan = drift._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")
    assert plan.count("schemaofvariant") <= 2  # one call, printed under two names


def test_session_messages_are_written_by_every_task(spark, tmp_path, monkeypatch):
    events = spark.range(0, 4000, 1, 4).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 30 AS int)) AS ts", "id % 50 AS user_id",
        "'view' AS event_type", "cast(id AS double) AS value", """'{"k": ' || (id % 80) || '}' AS props""",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(flow_queries, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    found = flow_queries._session_messages(spark, str(tmp_path)).agg({"event_count": "sum"}).first()[0]
    assert found == sum(i % 30 != 29 for i in range(4000))  # the windows of the last day are open
    for part in range(3):
        files = (tmp_path / "session-messages" / "in" / f"part={part}").glob("*.txt")
        assert sum(f.stat().st_size > 0 for f in files) > 1


def _shop_inputs(spark):
    def log(table, docs):
        rows = [(table, "INSERT", doc) for doc in docs]
        stamped = spark.createDataFrame(rows, "cdc_table string, cdc_operation string, after_data string")
        return stamped.selectExpr(
            "*", "cast(null as string) before_data", "timestamp'2024-01-01' cdc_timestamp", "timestamp'2024-01-01' ingested_at"
        )

    orders = ['{"order_id":1,"user_id":5,"total_amount":10.0,"ordered_at":"2024-01-01T00:00:00Z"}'] * 2
    items = [f'{{"item_id":{i},"order_id":1,"product_id":7,"quantity":2}}' for i in (1, 2)]
    events = spark.createDataFrame([("e", "search", "s")], "event_id string, event_type string, session_id string").selectExpr(
        "*", "timestamp'2024-01-01' event_timestamp", "5L user_id", "'ios' device_type",
        *[f"cast(null as string) {n}" for n in ("page_url", "referrer", "utm_source", "utm_medium", "utm_campaign", "properties")],
        "timestamp'2024-01-01' ingested_at",
    )
    logs = [log("orders", orders), log("products", ['{"product_id":7}']), log("order_items", items), log("users", ['{"user_id":5}'])]
    return [*logs, events]


def test_staging_tables_are_built_side_by_side(spark, tmp_path, monkeypatch):
    meeting, store = threading.Barrier(5), Lake.store

    def together(self, df, layer, name):
        if layer == "staging":
            meeting.wait(30)  # breaks if the five tables are stored one after another
        return store(self, df, layer, name)

    monkeypatch.setattr(Lake, "store", together)
    lake = Lake(spark, str(tmp_path))
    log = daily.run_batch(lake, *_shop_inputs(spark))
    names = ["orders", "products", "order_items", "users", "user_events", "daily_sales", "daily_funnel"]
    assert [(e[1], e[2], e[3]) for e in log.entries] == [(n, "success", 2 if n == "order_items" else 1) for n in names]
    sold = lake.read("mart", "daily_sales").collect()
    assert [(r.order_count, r.total_revenue, r.total_items_sold) for r in sold] == [(1, 20.0, 4)]
    assert lake.read("monitoring", "run_log").count() == 7


def test_a_failed_table_stops_the_marts_and_is_logged(spark, tmp_path, monkeypatch):
    store = Lake.store

    def fails(self, df, layer, name):
        if name in ("products", "users"):
            raise ConnectionError(name)
        return store(self, df, layer, name)

    monkeypatch.setattr(Lake, "store", fails)
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(ConnectionError, match="products"):
        daily.run_batch(lake, *_shop_inputs(spark))
    status = {r.table_name: r.status for r in lake.read("monitoring", "run_log").collect()}
    assert status == {n: "error" if n in ("products", "users") else "success" for n in ("orders", "products", "order_items", "users", "user_events")}
    assert not lake.exists("mart", "daily_sales")


def _given_tables(spark, root):
    n = spark.range(0, 600, 1, 2)
    n.selectExpr(
        "id AS o_orderkey", "id % 40 AS o_custkey", "substr('FOP', cast(id % 3 AS int) + 1, 1) AS o_orderstatus",
        "cast(id * 100.5 AS double) AS o_totalprice", "timestamp'1995-06-01' + make_interval(0, 0, 0, cast(id % 400 AS int)) AS o_orderdate",
        "CASE WHEN id % 2 = 0 THEN '5-LOW' ELSE '2-HIGH' END AS o_orderpriority",
    ).write.parquet(f"{root}/orders.parquet")
    n.selectExpr(
        "id % 500 AS l_orderkey", "id % 30 AS l_partkey", "cast(id % 7 AS int) AS l_linenumber", "cast(id % 9 + 1 AS double) AS l_quantity",
        "cast(id * 10.25 AS double) AS l_extendedprice", "timestamp'1995-07-01' + make_interval(0, 0, 0, cast(id % 400 AS int)) AS l_shipdate",
    ).write.parquet(f"{root}/lineitem.parquet")
    n.limit(30).selectExpr(
        "id AS p_partkey", "'part ' || id AS p_name", "'Brand#' || (id % 4) AS p_brand", "'T' || (id % 3) AS p_type",
        "cast(id + 1 AS int) AS p_size", "cast(id + 0.5 AS double) AS p_retailprice",
    ).write.parquet(f"{root}/part.parquet")
    n.limit(40).selectExpr("id AS c_custkey", "'c' || id AS c_name", "'X' AS c_mktsegment").write.parquet(f"{root}/customer.parquet")
    n.selectExpr(
        "id AS event_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 30 AS int)) AS ts", "id % 50 AS user_id",
        "'view' AS event_type", "cast(id AS double) AS value", """'{"k": ' || (id % 80) || '}' AS props""",
    ).write.parquet(f"{root}/events.parquet")


def test_change_messages_are_packed_into_short_files(spark, tmp_path, monkeypatch):
    _given_tables(spark, tmp_path)
    monkeypatch.setattr(flow_queries, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    monkeypatch.setattr(flow_queries, "_MESSAGES_PER_FILE", 100)
    splits, before = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    start = jobs.cdc_microbatch

    def started(messages, *args, **more):
        splits.append(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        return start(messages, *args, **more)

    monkeypatch.setattr(jobs, "cdc_microbatch", started)
    found = sorted(map(str, flow_queries._source_cdc_stream(spark, str(tmp_path)).collect()))
    logs = [flow_queries._change_rows(t.changes(spark, str(tmp_path), n)).collect() for n in flow_queries.TABLES]
    assert found == sorted(str(row) for log in logs for row in log)
    files = list((tmp_path / "cdc" / "files").glob("part-*"))
    texts = [gzip.decompress(f.read_bytes()) for f in files]
    assert all(0 < len(x.splitlines()) <= 100 for x in texts)  # a packed file cannot be split
    assert sum(f.stat().st_size for f in files) * 4 < sum(map(len, texts))
    assert splits == ["16m"] and spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_daily_batch_of_streams_leaves_no_passing_rows(spark, tmp_path, monkeypatch):
    _given_tables(spark, tmp_path)
    folders, left = [], []

    def shared(spark, purpose):
        folders.append(tmp_path / "shared" / f"{len(folders)}-{purpose}")
        return str(folders[-1])

    monkeypatch.setattr(flow_queries, "shared_folder", shared)
    monkeypatch.setattr(lake_module, "shared_folder", shared)
    run = daily.run_batch_from_streams

    def taken(lake, *args):
        left.append(sorted(p.name for n in ("changes", "events") for p in (folders[0] / n / "in").iterdir() if p.is_dir()))
        return run(lake, *args)

    monkeypatch.setattr(daily, "run_batch_from_streams", taken)
    switch = next(iter(daily.DROP_SHUFFLES))
    before = spark.conf.get(switch)
    found = flow_queries._run_batch_streams(spark, str(tmp_path))
    logs = [t.changes(spark, str(tmp_path), n) for n in flow_queries.TABLES]
    whole = Lake(spark, f"{tmp_path}/whole", date_unit="month")
    daily.run_batch(whole, *logs, t.user_events(spark, str(tmp_path)))
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.read("mart", "daily_sales").collect()))
    assert left == [[], []]  # messages that both streams have confirmed
    assert len(folders) > 10 and [f.name for f in folders if f.exists()] == [folders[0].name]
    assert spark.conf.get(switch) == before
    rows = {(r.table_name, r.rows_processed) for r in Lake(spark, str(folders[0])).read("monitoring", "run_log").collect()}
    assert ("products", 30) in rows and ("users", 40) in rows


def test_rows_put_aside_go_when_a_merge_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake_module, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    lake = Lake(spark, f"{tmp_path}/lake")
    lake.bootstrap_layers()

    def fails(*args):
        raise ConnectionError("users")

    monkeypatch.setattr(Lake, "ctas_replace", fails)
    new = spark.createDataFrame([], lake.read("staging", "users").schema)
    with pytest.raises(ConnectionError):
        lake.merge(new, "staging", "users", ["user_id"], ["_cdc_timestamp"])
    assert sorted(p.name for p in tmp_path.iterdir()) == ["lake"]


def test_shuffles_of_the_daily_job_go_with_their_step(spark, tmp_path, monkeypatch):
    switches, aside = [], Lake._aside

    def seen(self, df, folder):
        switches.append(spark.conf.get(next(iter(daily.DROP_SHUFFLES))))
        return aside(self, df, folder)

    monkeypatch.setattr(Lake, "_aside", seen)
    lake = Lake(spark, str(tmp_path))
    lake.bootstrap_layers()
    daily.run_batch_since(lake, *_shop_inputs(spark))
    assert switches and set(switches) == {"true"}
