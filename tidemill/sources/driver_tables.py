"""The given test tables in the shapes the operators expect.

Column expressions are plain SQL that Spark and the checking engine both accept, so each mapping is stated
once. A mapping only renames, relabels or formats; every row of the given table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Reference dates for the given data: one day after its last row.
EVENTS_AS_OF = "2024-01-31"
EVENTS_AS_OF_TS = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-02"

# props is the text {"k": n}
K = "cast(replace(substr(props, 7), '}', '') as int)"
SESSION = "'s-' || cast(user_id as string) || '-' || cast(cast(ts as date) as string)"
_AMOUNT = "cast(cast(value as decimal(12,2)) as string)"

USER_EVENTS = {
    "event_id": "'evt-' || lpad(cast(event_id as string), 10, '0')",
    "event_type": """case event_type
        when 'view' then case when k < 50 then 'page_view' else 'product_view' end
        when 'click' then case when k < 60 then 'add_to_cart' else 'begin_checkout' end
        when 'purchase' then 'purchase'
        when 'signup' then case when k < 50 then 'search' else 'app_open' end
        else 'remove_from_cart' end""",
    "event_timestamp": "cast(ts as timestamp)",
    "user_id": "case when k = 13 then null else user_id end",
    "session_id": SESSION,
    "device_type": """case user_id % 4 when 0 then 'ios' when 1 then 'android'
        when 2 then 'web_mobile' else 'web_desktop' end""",
    "page_url": "'/p/' || cast(k % 20 as string)",
    "referrer": "cast(null as string)",
    "utm_source": "case when k < 10 then 'newsletter' end",
    "utm_medium": "case when k < 10 then 'email' end",
    "utm_campaign": "cast(null as string)",
    "properties": f"""case
        when event_type in ('view', 'click') then '{{"product_id":' || cast(k + 1 as string) || '}}'
        when event_type = 'signup' then '{{"search_query":"q' || cast(k as string) || '","result_count":"'
            || cast(k % 7 as string) || '"}}'
        when event_type = 'purchase' and k < 80 then '{{"order_id":' || cast(event_id as string)
            || ',"total_amount":' || {_AMOUNT} || ',"item_count":' || cast(k % 5 + 1 as string) || '}}'
        else '{{}}' end""",
}
REDELIVERED = "k between 40 and 42"

PAY_EVENTS = {
    "event_id": "'pay-' || lpad(cast(event_id as string), 10, '0')",
    "event_name": """case event_type
        when 'view' then 'payment.view.checkout_screen'
        when 'click' then case when k < 60 then 'payment.click.payment_method_select'
            else 'payment.submit.payment_request' end
        when 'purchase' then case when k < 90 then 'payment.complete.payment_success'
            else 'payment.complete.refund' end
        when 'signup' then case when k < 80 then 'auth.complete.login' when k < 90 then 'transfer.complete.to_account'
            else 'transfer.fail.to_account' end
        else case when k < 50 then 'payment.fail.payment_error' when k < 98 then 'error.occur.app_crash'
            else 'PaymentSuccess' end end""",
    "event_timestamp": "cast(ts as timestamp)",
    "user_id": """case when user_id < 2 then 'test_' when user_id < 4 then 'anonymous_'
        when user_id < 6 then 'internal_' else 'user_' end || cast(user_id as string)""",
    "session_id": SESSION,
    "device_id": "'dev-' || cast(user_id as string)",
    "device_type": "case user_id % 3 when 0 then 'ios' when 1 then 'android' else 'web' end",
    "app_version": "case when k = 77 then 'beta' else '3.2.' || cast(k % 5 as string) end",
    "os_version": "cast(null as string)",
    "screen_name": "cast(null as string)",
    "transaction_id": """case when event_type = 'purchase' or (event_type = 'error' and k < 50)
        then 'TXN-' || lpad(cast(user_id * 100 + k % 30 as string), 8, '0') end""",
    "amount": """cast(case
        when event_type = 'purchase' and k < 90 then round(value * 100)
        when event_type = 'purchase' then round(value * 10)
        when event_type = 'signup' and k >= 80 then round(value * 100) end as bigint)""",
    "payment_method": """case when event_type = 'purchase' then
        case k % 4 when 0 then 'card' when 1 then 'bank_transfer' when 2 then 'app_balance' end end""",
    "merchant_id": "case when event_type = 'purchase' then 'm' || cast(k % 9 as string) end",
    "merchant_category": """case when event_type = 'purchase' and k % 11 <> 0
        then 'mcc' || cast(k % 7 as string) end""",
    "is_first_payment": "case when event_type = 'purchase' then k % 5 = 0 end",
    "transfer_id": "case when event_type = 'signup' and k >= 80 then 'TFR-' || cast(event_id as string) end",
    "from_account_type": "cast(null as string)",
    "to_account_type": "cast(null as string)",
    "error_code": "case when event_type = 'error' then 'E' || cast(k % 4 as string) end",
    "error_message": "cast(null as string)",
    "_ingested_at": "cast(ts as timestamp) + interval '1' second * k",
}
PAY_PROPERTIES = (
    "transaction_id", "amount", "payment_method", "merchant_id", "merchant_category", "is_first_payment",
    "transfer_id", "from_account_type", "to_account_type", "error_code", "error_message",
)

_STATUS = """case when o_orderstatus = 'F' then 'DELIVERED' when o_orderstatus = 'O' then 'SHIPPING'
        when o_orderpriority = '5-LOW' then 'CANCELLED' when o_orderpriority = '4-NOT SPECIFIED' then 'REFUNDED'
        else 'PENDING' end"""
_DELIVERY = """case when o_totalprice < 150000 then 'DAWN' when o_totalprice < 300000 then 'SAME_DAY'
        else 'NEXT_DAY' end"""
ORDERS = {
    "order_id": "o_orderkey",
    "user_id": "o_custkey",
    "order_status": _STATUS,
    "total_amount": "o_totalprice",
    "delivery_fee": "case when o_totalprice < 40000 then cast(3000 as double) else cast(0 as double) end",
    "payment_method": """case when o_orderpriority = '1-URGENT' then 'card'
        when o_orderpriority = '2-HIGH' then 'wallet' else 'bank_transfer' end""",
    "delivery_type": _DELIVERY,
    "ordered_at": "cast(o_orderdate as timestamp)",
}
ORDER_ITEMS = {
    "item_id": "l_orderkey * 10 + l_linenumber",
    "order_id": "l_orderkey",
    "product_id": "l_partkey",
    "quantity": "cast(l_quantity as bigint)",
    "subtotal": "l_extendedprice",
}
PRODUCTS = {
    "product_id": "p_partkey",
    "product_name": "p_name",
    "category_l1": "p_type",
    "category_l2": "p_brand",
    "price": "p_retailprice",
    "stock_quantity": "cast((p_size - 1) * 2 as bigint)",
    "storage_type": "case p_size % 3 when 0 then 'FROZEN' when 1 then 'CHILLED' else 'AMBIENT' end",
}


def _money(c: str) -> str:
    return f"cast(cast({c} as decimal(12,2)) as string)"


def _iso(c: str) -> str:
    return f"replace(cast(cast({c} as timestamp) as string), ' ', 'T') || 'Z'"


def _order_json(status: str, updated: str) -> str:
    return f"""'{{"order_id":' || cast(o_orderkey as string) || ',"user_id":' || cast(o_custkey as string)
        || ',"order_status":"' || {status} || '","total_amount":' || {_money("o_totalprice")}
        || ',"delivery_fee":0.00,"payment_method":"card","delivery_type":"' || {_DELIVERY}
        || '","ordered_at":"' || {_iso("o_orderdate")} || '","delivered_at":null,"updated_at":"'
        || {_iso(updated)} || '"}}'"""


_NO_JSON = "cast(null as string)"
_PRODUCT_JSON = """'{"product_id":' || cast(p_partkey as string) || ',"name":"' || p_name
        || '","category_l1":"' || p_type || '","category_l2":"' || p_brand || '","category_l3":null,"price":'
        || cast(cast(p_retailprice as decimal(12,2)) as string) || ',"discount_rate":@RATE,"stock_quantity":'
        || cast((p_size - 1) * 2 as string) || ',"is_exclusive":' || case when p_size > 30 then 'true' else 'false' end
        || ',"storage_type":"' || case p_size % 3 when 0 then 'FROZEN' when 1 then 'CHILLED' else 'AMBIENT' end || '"}'"""

# table -> (given table, [(op code, when it applies, change time, before, after)])
CHANGES = {
    "orders": (
        "orders",
        [
            ("c", "true", "cast(o_orderdate as timestamp)", _NO_JSON, _order_json("'PENDING'", "o_orderdate")),
            (
                "u",
                f"{_STATUS} <> 'PENDING'",
                "cast(o_orderdate as timestamp) + interval '1' day",
                _order_json("'PENDING'", "o_orderdate"),
                _order_json(_STATUS, "o_orderdate + interval '1' day"),
            ),
            (
                "d",
                f"{_STATUS} = 'CANCELLED'",
                "cast(o_orderdate as timestamp) + interval '2' day",
                _order_json(_STATUS, "o_orderdate + interval '1' day"),
                _NO_JSON,
            ),
        ],
    ),
    "products": (
        "part",
        [
            ("r", "true", "cast('2000-01-01' as timestamp)", _NO_JSON, _PRODUCT_JSON.replace("@RATE", "0.00")),
            (
                "u",
                "p_size > 25",
                "cast('2000-02-01' as timestamp)",
                _PRODUCT_JSON.replace("@RATE", "0.00"),
                _PRODUCT_JSON.replace("@RATE", "12.50"),
            ),
        ],
    ),
    "order_items": (
        "lineitem",
        [
            (
                "c",
                "true",
                "cast(l_shipdate as timestamp)",
                _NO_JSON,
                f"""'{{"item_id":' || cast(l_orderkey * 10 + l_linenumber as string) || ',"order_id":'
                || cast(l_orderkey as string) || ',"product_id":' || cast(l_partkey as string) || ',"quantity":'
                || cast(cast(l_quantity as int) as string) || ',"unit_price":'
                || cast(cast(floor(l_extendedprice / l_quantity) as bigint) as string) || ',"subtotal":' || {_money("l_extendedprice")}
                || ',"created_at":"' || {_iso("l_shipdate")} || '"}}'""",
            )
        ],
    ),
    "users": (
        "customer",
        [
            (
                "r",
                "true",
                "cast('1994-01-01' as timestamp)",
                _NO_JSON,
                """'{"user_id":' || cast(c_custkey as string) || ',"email":"u' || cast(c_custkey as string)
                || '@example.org","name":"' || c_name || '","grade":"' || c_mktsegment
                || '","created_at":"1994-01-01T00:00:00Z"}'""",
            )
        ],
    ),
}

# Text of an event message: well formed for most k, broken in a fixed way for a few values of k.
RAW_MESSAGE = f"""case
    when k = 97 then 'not json ' || event_id
    when k = 96 then '[1]'
    when k = 95 then '{{"event_id":"' || event_id || '","event_type":"' || event_type || '"}}'
    when k = 94 then '{{"event_id":"' || event_id || '","event_type":null,"session_id":"' || session_id || '"}}'
    else '{{"event_id":"' || case when k = 90 then 'e' || cast(k as string) else event_id end
        || '","event_type":"' || case when k = 89 then 'teleport' else upper(event_type) end
        || '"' || case when k = 92 then '' else ',"event_timestamp":"'
            || case when k = 93 then 'bad' else {_iso("event_timestamp")} end || '"' end
        || case when user_id is null then '' else ',"user_id":' || cast(user_id as string) end
        || ',"session_id":"' || session_id || '","device_type":"'
        || case when k = 91 then 'smart_tv' else device_type end
        || '","page_url":"' || page_url || '","properties":' || properties || '}}' end"""

# Text of a payment-app event message.
RAW_PAY_MESSAGE = f"""'{{"event_id":"' || event_id || '","event_name":"' || event_name || '","event_timestamp":"'
    || {_iso("event_timestamp")} || '"' || case when k = 88 then '' else ',"user_id":"' || user_id || '"' end
    || ',"session_id":"' || session_id || '","device_id":"' || device_id || '","device_type":"'
    || case when k = 87 then 'tv' else device_type end || '","app_version":"' || app_version || '"'
    || case when k = 86 then ',"surprise":1' when k = 83 then ',"os_version":17' else '' end
    || case when k = 82 then ',"properties":7,"screen_name":{{"note":"x"' else ',"properties":{{"note":"x"' end
    || case when k = 81 then ',"is_first_payment":"yes","merchant_id":5' else ',"is_first_payment":true' end
    || case when amount is null then '' else ',"amount":'
        || case when k = 85 then '-' || cast(amount as string) when k = 80 then '"' || cast(amount as string) || '"'
            else cast(amount as string) end end
    || case when payment_method is null then '' else ',"payment_method":"'
        || case when k = 84 then 'cash' else payment_method end || '"' end || '}}}}'"""


def _pick(df: DataFrame, columns: dict[str, str], *extra: str) -> DataFrame:
    return df.selectExpr(*[f"{expr} as {name}" for name, expr in columns.items()], *extra)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_k(events: DataFrame) -> DataFrame:
    return events.selectExpr("*", f"{K} as k")


def user_events_of(events: DataFrame) -> DataFrame:
    """Raw user events, some delivered a second time one hour later."""
    mapped = _pick(with_k(events), USER_EVENTS, "k")
    delays = F.when(F.expr(REDELIVERED), F.array(F.lit(0), F.lit(3600))).otherwise(F.array(F.lit(0)))
    return (
        mapped.withColumn("_delay", F.explode(delays))
        .withColumn("ingested_at", F.expr("event_timestamp + interval '1' second * (k + _delay)"))
        .drop("_delay", "k")
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_events_of(given(spark, sf_dir, "events"))


def user_events_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event delivered once: the staging shape without running the de-duplication."""
    mapped = _pick(with_k(given(spark, sf_dir, "events")), USER_EVENTS, "k")
    return mapped.withColumn("ingested_at", F.expr("event_timestamp + interval '1' second * k")).drop("k")


def raw_messages_of(events: DataFrame) -> DataFrame:
    return _pick(with_k(events), USER_EVENTS, "k").selectExpr(f"{RAW_MESSAGE} as value")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages_of(given(spark, sf_dir, "events"))


def raw_pay_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(with_k(given(spark, sf_dir, "events")), PAY_EVENTS, "k").selectExpr(
        "event_id as key", f"{RAW_PAY_MESSAGE} as value"
    )


def pay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _pick(with_k(given(spark, sf_dir, "events")), PAY_EVENTS)
    others = [c for c in flat.columns if c not in PAY_PROPERTIES]
    return flat.select(*others, F.struct(*PAY_PROPERTIES).alias("properties"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(given(spark, sf_dir, "orders"), ORDERS)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(given(spark, sf_dir, "lineitem"), ORDER_ITEMS)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(given(spark, sf_dir, "part"), PRODUCTS)


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a file stream. The pattern matches one file as well as a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


def _versions_of(df: DataFrame, table: str) -> DataFrame:
    """One row per version that applies. Rows are repeated by the number of the version, so that documents are built behind
    the generator and only where they are asked for."""
    versions = CHANGES[table][1]
    if [v[1] for v in versions] == ["true"]:
        numbered = df.selectExpr("*", "0 as _version")
    else:
        options = [f"case when {v[1]} then {i} end" for i, v in enumerate(versions)]
        numbered = df.selectExpr("*", f"explode(array_compact(array({', '.join(options)}))) as _version")

    def pick(place: int, quote: str = "") -> str:
        if len(versions) == 1:
            return f"{quote}{versions[0][place]}{quote}"
        cases = " ".join(f"when {i} then {quote}{v[place]}{quote}" for i, v in enumerate(versions))
        return f"case _version {cases} end"

    return numbered.selectExpr(
        f"{pick(0, chr(39))} as op", f"{pick(2)} as changed_at", f"{pick(3)} as before", f"{pick(4)} as after"
    )


def change_messages_of(df: DataFrame, table: str) -> DataFrame:
    """Change envelopes of one table as JSON text, one scan of the given table."""
    return _versions_of(df, table).selectExpr(
        f"""'{{"before":' || coalesce(before, 'null') || ',"after":' || coalesce(after, 'null')
        || ',"source":{{"table":"{table}","db":"shop"}},"op":"' || op || '","ts_ms":'
        || cast(unix_millis(changed_at) as string) || '}}' as value"""
    )


def change_messages(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return change_messages_of(given(spark, sf_dir, CHANGES[table][0]), table)


def changes(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Change rows of one table as the raw layer stores them."""
    labels = "case op when 'c' then 'INSERT' when 'u' then 'UPDATE' when 'd' then 'DELETE' else 'SNAPSHOT' end"
    return _versions_of(given(spark, sf_dir, CHANGES[table][0]), table).selectExpr(
        f"'{table}' as cdc_table",
        f"{labels} as cdc_operation",
        "changed_at as cdc_timestamp",
        "before as before_data",
        "after as after_data",
        "coalesce(after, before, '{}') as raw_payload",
        "changed_at as ingested_at",
    )
