"""Declared schemas. Tables are read with these; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(columns: str, **nested: T.DataType) -> T.StructType:
    """``name type [NOT NULL]`` pairs; ``nested`` gives the type of columns stated as ``struct``."""
    fields = []
    for column in columns.split(","):
        name, kind, *rest = column.split()
        fields.append(T.StructField(name, nested[name] if kind == "struct" else _TYPES[kind], not rest))
    return T.StructType(fields)


_CONTEXT = "page_url string, referrer string, utm_source string, utm_medium string, utm_campaign string"

# One JSON event message as producers send it.
EVENT_MESSAGE = _schema(
    "event_id string, event_type string, event_timestamp string, user_id bigint, session_id string, "
    f"device_type string, device_id string, app_version string, {_CONTEXT}, properties string"
)

RAW_USER_EVENTS = _schema(
    "event_id string NOT NULL, event_type string NOT NULL, event_timestamp timestamp, user_id bigint, "
    f"session_id string NOT NULL, device_type string, device_id string, app_version string, {_CONTEXT}, "
    "properties string, ingested_at timestamp"
)

# What the streaming job appends: the raw columns plus what enrichment adds.
ENRICHED_EVENTS = _schema(
    "event_id string, event_type string, event_timestamp timestamp, event_date date, event_hour bigint, "
    f"user_id bigint, session_id string, device_type string, device_id string, app_version string, {_CONTEXT}, "
    "properties string, ingested_at timestamp, processed_at timestamp, pipeline_version string"
)

SESSION_AGGREGATIONS = _schema(
    "session_id string, event_count bigint, event_types array<string>, user_id bigint, device_type string, "
    "first_event_at timestamp, last_event_at timestamp, has_purchase boolean, window_start timestamp"
)

DEAD_LETTERS = _schema("raw_data string NOT NULL, error_timestamp timestamp NOT NULL")

RAW_CHANGES = _schema(
    "cdc_table string NOT NULL, cdc_operation string NOT NULL, cdc_timestamp timestamp NOT NULL, "
    "before_data string, after_data string, raw_payload string, ingested_at timestamp NOT NULL"
)

STAGING_ORDERS = _schema(
    "order_id bigint, user_id bigint, order_status string, total_amount double, delivery_fee double, "
    "payment_method string, delivery_type string, ordered_at timestamp, delivered_at timestamp, "
    "updated_at timestamp, _cdc_timestamp timestamp, _etl_loaded_at timestamp"
)

STAGING_PRODUCTS = _schema(
    "product_id bigint, product_name string, category_l1 string, category_l2 string, category_l3 string, "
    "price double, discount_rate double, stock_quantity bigint, is_exclusive boolean, storage_type string, "
    "_cdc_timestamp timestamp, _etl_loaded_at timestamp"
)

STAGING_ORDER_ITEMS = _schema(
    "item_id bigint, order_id bigint, product_id bigint, quantity bigint, unit_price double, subtotal double, "
    "created_at timestamp, _cdc_timestamp timestamp, _etl_loaded_at timestamp"
)

STAGING_USERS = _schema(
    "user_id bigint, email string, name string, grade string, created_at timestamp, "
    "_cdc_timestamp timestamp, _etl_loaded_at timestamp"
)

STAGING_USER_EVENTS = _schema(
    "event_id string, event_type string, event_timestamp timestamp, user_id bigint, session_id string, "
    f"device_type string, {_CONTEXT}, properties string, ingested_at timestamp, _etl_loaded_at timestamp"
)

MART_DAILY_SALES = _schema(
    "order_date date, delivery_type string, category_l1 string, storage_type string, order_count bigint, "
    "unique_customers bigint, total_revenue double, avg_order_value double, total_items_sold bigint, "
    "cancelled_orders bigint, cancellation_rate double"
)

MART_DAILY_FUNNEL = _schema(
    "event_date date, device_type string, sessions bigint, product_views bigint, add_to_carts bigint, "
    "checkouts bigint, purchases bigint, view_rate double, cart_rate double, purchase_rate double"
)

QUALITY_CHECKS = _schema(
    "check_name string NOT NULL, table_name string NOT NULL, status string NOT NULL, metric_value double, "
    "threshold double, details string, checked_at timestamp NOT NULL"
)

# Extension properties of payment-app events.
PAYMENT_PROPERTIES = _schema(
    "transaction_id string, amount bigint, payment_method string, merchant_id string, "
    "merchant_category string, is_first_payment boolean, transfer_id string, from_account_type string, "
    "to_account_type string, error_code string, error_message string"
)

PAYMENT_EVENTS = _schema(
    "event_id string, event_name string, event_timestamp timestamp, user_id string, session_id string, "
    "device_id string, device_type string, app_version string, os_version string, screen_name string, "
    "properties struct, _ingested_at timestamp",
    properties=PAYMENT_PROPERTIES,
)

STG_TRANSACTIONS = _schema(
    "event_timestamp timestamp, user_id string, session_id string, transaction_id string, amount bigint, "
    "payment_method string, merchant_id string, merchant_category string, is_first_payment boolean, "
    "event_name string, transaction_status string"
)

# One row per user: first login day, and bit i set for a login i days later.
STAGING_LOGIN_DAYS = _schema("user_id string, first_day date, days bigint")

CDC_TABLES = ("users", "products", "orders", "order_items")

# Marts hold a few rows per day however large the input is, so they are sorted by date rather than split by it.
# layer -> table -> (schema, partition column, sort columns inside a partition)
LAYERS = {
    "raw": {
        "user_events": (ENRICHED_EVENTS, "event_date", ("event_type", "device_type")),
        "session_aggregations": (SESSION_AGGREGATIONS, None, ()),
        "dead_letter_events": (DEAD_LETTERS, None, ()),
        **{f"cdc_{t}": (RAW_CHANGES, "cdc_date", ("cdc_operation",)) for t in CDC_TABLES},
    },
    "staging": {
        "orders": (STAGING_ORDERS, "ordered_date", ("order_status", "user_id")),
        "products": (STAGING_PRODUCTS, None, ("category_l1", "storage_type")),
        "order_items": (STAGING_ORDER_ITEMS, "created_date", ("order_id",)),
        "users": (STAGING_USERS, None, ("user_id",)),
        "user_events": (STAGING_USER_EVENTS, "event_date", ("event_type", "user_id")),
        "login_days": (STAGING_LOGIN_DAYS, None, ("user_id",)),
    },
    "mart": {
        "daily_sales": (MART_DAILY_SALES, None, ("order_date",)),
        "daily_funnel": (MART_DAILY_FUNNEL, None, ("event_date",)),
    },
    "monitoring": {"data_quality_checks": (QUALITY_CHECKS, "checked_date", ())},
}
