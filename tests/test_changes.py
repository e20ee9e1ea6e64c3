import json

from pyspark.sql import functions as F

from tidemill.functions.exprs import moment
from tidemill.operators import changes as c

NOW = "2024-01-01 00:00:00"


def _envelope(op, before, after, table="orders", ts=1700000000000):
    return json.dumps({"before": before, "after": after, "source": {"table": table, "db": "shop"}, "op": op, "ts_ms": ts})


def _rows(spark, *messages):
    raw = spark.createDataFrame([(m,) for m in messages], "value string")
    good, dead = c.parse_cdc(raw)
    return c.cdc_to_row(good, now=moment(NOW)).collect(), dead.count()


def test_envelopes(spark):
    order = {"order_id": 1, "user_id": 42, "order_status": "PENDING", "total_amount": 29900.0}
    rows, dead = _rows(
        spark,
        _envelope("c", None, order),
        _envelope("u", {"order_id": 1}, {"order_id": 1, "order_status": "PAID"}, ts=1700000001000),
        _envelope("d", {"order_id": 1}, None, ts=1700000002000),
        _envelope("x", None, None),
        "{}",
        "broken",
    )
    assert dead == 1
    assert [r.cdc_operation for r in rows] == ["INSERT", "UPDATE", "DELETE", "UNKNOWN", "UNKNOWN"]
    assert rows[0].cols["order_id"] == "1" and rows[0].before_data is None
    assert rows[1].before_data is not None
    assert json.loads(rows[2].raw_payload) == {"order_id": 1} and rows[2].after_data is None
    assert rows[3].raw_payload == "{}"
    assert rows[4].cdc_table == "unknown" and rows[4].cdc_timestamp.year == 1970


def _log(spark):
    def after(i, status):
        return json.dumps({"order_id": i, "order_status": status, "total_amount": "12.5", "ordered_at": "2024-01-01T00:00:00Z"})

    rows = [
        ("INSERT", "2024-01-01 00:00:00", None, after(1, "NEW")),
        ("UPDATE", "2024-01-02 00:00:00", after(1, "NEW"), after(1, "PAID")),
        ("DELETE", "2024-01-03 00:00:00", after(1, "PAID"), None),
        ("INSERT", "2024-01-01 00:00:00", None, after(2, "NEW")),
        ("UPDATE", "2024-01-02 00:00:00", None, after(2, "PAID")),
        ("SNAPSHOT", "2024-01-01 00:00:00", None, after(3, "OLD")),
        ("INSERT", "2024-01-01 00:00:00", None, '{"order_id": 4, "total_amount": "dirty", "ordered_at": "never"}'),
    ]
    df = spark.createDataFrame(rows, "cdc_operation string, t string, before_data string, after_data string")
    return df.selectExpr("*", "to_timestamp(t) as cdc_timestamp", "to_timestamp(t) as ingested_at")


def test_latest_state_keeps_last_live_row(spark):
    rows = {r.order_id: r for r in c.stg_orders(_log(spark), now=moment(NOW)).collect()}
    assert {k: v.order_status for k, v in rows.items()} == {1: "PAID", 2: "PAID", 3: "OLD", 4: None}
    assert rows[4].total_amount is None and rows[4].ordered_at is None


def test_latest_state_can_drop_deleted(spark):
    ids = {r.order_id for r in c.stg_orders(_log(spark), drop_deleted=True, now=moment(NOW)).collect()}
    assert ids == {2, 3, 4}


def test_decimal_money(spark):
    df = c.latest_state(_log(spark), "order_id", c.with_decimal_money(c.ORDER_FIELDS), now=moment(NOW))
    assert df.schema["total_amount"].dataType.simpleString() == "decimal(12,2)"
    assert str(df.filter("order_id = 1").first().total_amount) == "12.50"


def test_empty_object_with_many_blanks(spark):
    padded, held = "{" + " \n" * 60 + "}", '{"a": "' + " " * 90 + '"}'
    rows = [("orders", "u", padded, held, 0), ("orders", "u", held, "{ }", 1)]
    events = spark.createDataFrame(rows, "table_name string, op string, before string, after string, ts_ms long")
    out = c.cdc_to_row(events, now=moment(NOW)).orderBy("cdc_timestamp").collect()
    assert [(r.before_data, r.after_data, r.raw_payload) for r in out] == [(None, held, held), (held, None, held)]


def test_document_drift(spark):
    declared = {"t": {"id": ("id", "bigint"), "sum": ("sum", "decimal(12,2)"), "at": ("at", "timestamp"), "gone": ("gone", "string")}}
    rows = [
        ("t", "2024-01-01 10:00:00", None, '{"id": 1, "sum": 2, "at": "x", "more": {"a": 1}}'),
        ("t", "2024-01-01 11:00:00", None, '{"id": "1", "sum": 2.5, "at": null, "gone": null}'),
        ("t", "2024-01-02 00:00:00", '{"id": 2, "sum": 1.0, "at": "y", "gone": "z"}', None),
        ("t", "2024-01-03 00:00:00", None, "broken"),
        ("t", "2024-01-03 00:00:00", None, None),
        ("u", "2024-01-01 00:00:00", None, '{"flag": true}'),
        (None, None, None, '{"flag": [1]}'),
        ("u", "2024-01-01 00:00:00", None, '{}'),
    ]
    changes = spark.createDataFrame(rows, "cdc_table string, at string, before_data string, after_data string").select(
        "cdc_table", F.to_timestamp("at").alias("cdc_timestamp"), "before_data", "after_data"
    )
    found = {(r.cdc_table, r.cdc_date and r.cdc_date.day, r.member): tuple(r)[3:] for r in c.document_drift(changes, declared).collect()}
    assert found == {
        ("t", 1, "id"): ("retyped", "bigint", "text,whole", 2),
        ("t", 1, "more"): ("new", None, "nested", 1),
        **{("t", 3, m): ("missing", kind, None, 0) for m, kind in declared["t"].values()},
        ("u", 1, "flag"): ("new", None, "boolean", 1),
        (None, None, "flag"): ("new", None, "nested", 1),
    }
    assert c.document_drift(changes.limit(0), declared).count() == 0
    assert c.document_drift(changes, {}).filter("problem <> 'new'").count() == 0
