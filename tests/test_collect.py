import datetime as dt

from pyspark.sql import functions as F

from tidemill.functions.exprs import moment
from tidemill.operators import collect as k
from tidemill.operators import taxonomy as x

NOW = "2024-02-01 05:00:00"


def _messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def _event(**fields):
    import json

    base = {"event_id": "event-0001", "event_type": "page_view", "session_id": "s1", "device_type": "ios"}
    return json.dumps({**base, **fields})


def test_parse_splits_dead_letters(spark):
    raw = _messages(
        spark, _event(), '{"event_id":"a","event_type":"b"}', _event(event_type=None), "[1]", "not json"
    )
    events, dead = k.parse_events(raw)
    assert events.count() == 1
    assert dead.count() == 4
    assert k.parse_counters(raw).first() == (1, 4)


def test_bytes_that_are_not_text_are_dead(spark):
    raw = spark.createDataFrame([(bytearray(b"\xff\xfe"),), (bytearray(_event().encode()),)], "value binary")
    events, dead = k.parse_events(raw)
    assert events.count() == 1
    assert dead.count() == 1


def test_enrich_dates(spark):
    raw = _messages(
        spark, _event(event_timestamp="2024-01-01T23:59:59Z"), _event(event_timestamp="bad"), _event(event_type="Search")
    )
    rows = k.enrich_events(k.parse_events(raw)[0], now=moment(NOW)).collect()
    assert [(r.event_date.isoformat(), r.event_hour) for r in rows] == [
        ("2024-01-01", 23), ("2024-02-01", 5), ("2024-02-01", 5),
    ]
    assert rows[2].event_type == "search"


def test_validation_of_reference_inputs(spark):
    raw = _messages(
        spark,
        _event(event_id="550e8400-e29b-41d4-a716-446655440000", user_id=42),
        _event(event_id="short"),
        _event(event_id="test-event-12345", event_type="product_view", device_type="web_desktop", user_id=100),
        _event(device_type="fridge"),
        _event(event_type="teleport"),
    )
    rows = k.validate_events(k.parse_events(raw)[0]).select("errors").collect()
    assert [r.errors for r in rows] == [[], ["event_id"], [], ["device_type"], ["event_type"]]


def test_typed_events(spark):
    raw = _messages(
        spark,
        _event(event_type="product_view", properties={"product_id": 456, "price": 4900.0}),
        _event(event_type="product_view", properties={}),
        _event(event_type="purchase", properties={"order_id": 789, "total_amount": 29900.0, "item_count": 3}),
        _event(event_type="purchase", properties={"order_id": 789}),
        _event(event_type="search", properties={"search_query": "milk", "result_count": 15}),
        _event(event_type="search", properties={"search_query": "milk"}),
    )
    rows = k.validate_typed_events(k.parse_events(raw)[0]).collect()
    assert [r.errors for r in rows] == [[], ["product_id"], [], ["total_amount", "item_count"], [], []]
    assert [r.result_count for r in rows] == [None, None, None, None, 15, 0]


def test_batch_limits(spark):
    rows = [("a", []), ("a", ["event_id"]), *[("b", []) for _ in range(501)]]
    df = spark.createDataFrame(rows, "batch string, errors array<string>")
    out = {r.batch: r for r in k.validate_event_batch(df, "batch").collect()}
    assert (out["a"].total, out["a"].published, out["a"].failed, out["a"].accepted) == (2, 1, 1, True)
    assert not out["b"].accepted


def test_row_has_all_raw_columns(spark):
    df = spark.createDataFrame(
        [("test-event-12345", "product_view", "sess-abc", "web_desktop", 100, "/products/123", {"a": "1"})],
        "event_id string, event_type string, session_id string, device_type string, user_id bigint, "
        "page_url string, properties map<string,string>",
    )
    row = k.event_to_row(df, now=moment(NOW)).first()
    assert len(row) == 15
    assert row.properties == '{"a":"1"}'
    assert row.ingested_at == dt.datetime(2024, 2, 1, 5)


def test_session_windows(spark):
    rows = [
        ("e1", "s1", "page_view", 1, "ios", "2024-01-01 00:00:10"),
        ("e2", "s1", "purchase", 1, "ios", "2024-01-01 00:00:50"),
        ("e3", "s1", "page_view", 2, "ios", "2024-01-01 00:01:00"),
    ]
    df = spark.createDataFrame(
        rows, "event_id string, session_id string, event_type string, user_id bigint, device_type string, t string"
    ).withColumn("event_time", F.to_timestamp("t"))
    out = k.session_window_agg(df).orderBy("window_start").collect()
    assert [(r.event_count, r.has_purchase, r.user_id) for r in out] == [(2, True, 1), (1, False, 2)]


def test_route_attributes_skip_missing_user(spark):
    df = spark.createDataFrame([("t", "ios", 7), ("t", "ios", None), ("t", "ios", 0)], "event_type string, device_type string, user_id bigint")
    sizes = [len(r.headers) for r in k.event_route_attributes(df).collect()]
    assert sizes == [3, 2, 2]


def test_taxonomy(spark):
    df = spark.createDataFrame([("auth.complete.login",), ("PaymentSuccess",), ("a.b",), (None,)], "event_name string")
    rows = x.parse_taxonomy(df).collect()
    assert [r.is_valid for r in rows] == [True, False, False, False]
    assert rows[0].event_label == "login" and rows[2].event_label is None


def test_message_schema(spark):
    import json

    good = {
        "event_id": "1", "event_name": "a.b.c", "event_timestamp": "2024-01-01T00:00:00Z", "user_id": "u",
        "session_id": "s", "device_id": "d", "device_type": "ios", "app_version": "1.2.3",
        "properties": {"amount": 5, "payment_method": None},
    }
    cases = [
        good, {**good, "extra": 1}, {**good, "app_version": "1.2"}, {**good, "properties": {"amount": -1}},
        {**good, "properties": {"payment_method": "cash"}}, {k: v for k, v in good.items() if k != "user_id"},
        {**good, "user_id": 5}, {**good, "properties": 7}, {**good, "properties": None}, {**good, "os_version": 17},
        {**good, "properties": {"amount": "12"}}, {**good, "properties": {"amount": 1.5, "is_first_payment": "yes"}},
        {**good, "event_timestamp": "2024-01-01"}, {**good, "properties": {"merchant_id": 4, "is_first_payment": True}},
    ]
    raw = _messages(spark, *[json.dumps(c) for c in cases], "nope")
    errors = [r.errors for r in x.validate_event_schema(raw).collect()]
    assert errors == [[], ["unknown_key"], ["app_version"], ["amount"], ["payment_method"], ["user_id"],
        ["user_id"], ["properties"], ["properties"], ["os_version"], ["amount"], ["amount", "is_first_payment"],
        ["event_timestamp"], ["merchant_id"], ["not_an_object"]]
    strict = x.validate_event_schema(raw.limit(1), check_formats=True)
    assert strict.first().errors == ["event_id"]
