"""Change-data capture: envelopes to change rows, change rows to current state."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exprs import json_scalar, typed
from tidemill.functions.keyed import first_per_key
from tidemill.operators.collect import message_text

ENVELOPE = (
    "before string, after string, source struct<table: string, db: string>, op string, ts_ms bigint, _broken string"
)

# Operation codes and their labels.
OPERATIONS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}

# Output column -> (member of the change document, type).
ORDER_FIELDS = {
    "order_id": ("order_id", "bigint"),
    "user_id": ("user_id", "bigint"),
    "order_status": ("order_status", "string"),
    "total_amount": ("total_amount", "double"),
    "delivery_fee": ("delivery_fee", "double"),
    "payment_method": ("payment_method", "string"),
    "delivery_type": ("delivery_type", "string"),
    "ordered_at": ("ordered_at", "timestamp"),
    "delivered_at": ("delivered_at", "timestamp"),
    "updated_at": ("updated_at", "timestamp"),
}
PRODUCT_FIELDS = {
    "product_id": ("product_id", "bigint"),
    "product_name": ("name", "string"),
    "category_l1": ("category_l1", "string"),
    "category_l2": ("category_l2", "string"),
    "category_l3": ("category_l3", "string"),
    "price": ("price", "double"),
    "discount_rate": ("discount_rate", "double"),
    "stock_quantity": ("stock_quantity", "bigint"),
    "is_exclusive": ("is_exclusive", "boolean"),
    "storage_type": ("storage_type", "string"),
}
ORDER_ITEM_FIELDS = {
    "item_id": ("item_id", "bigint"),
    "order_id": ("order_id", "bigint"),
    "product_id": ("product_id", "bigint"),
    "quantity": ("quantity", "bigint"),
    "unit_price": ("unit_price", "double"),
    "subtotal": ("subtotal", "double"),
    "created_at": ("created_at", "timestamp"),
}
USER_FIELDS = {
    "user_id": ("user_id", "bigint"),
    "email": ("email", "string"),
    "name": ("name", "string"),
    "grade": ("grade", "string"),
    "created_at": ("created_at", "timestamp"),
}
# The money columns of staging in their source precision.
DECIMAL_MONEY = {
    "total_amount": "decimal(12,2)",
    "delivery_fee": "decimal(8,2)",
    "price": "decimal(12,2)",
    "discount_rate": "decimal(5,2)",
    "unit_price": "decimal(12,2)",
    "subtotal": "decimal(12,2)",
}
Fields = Mapping[str, tuple[str, str]]


def with_decimal_money(fields: Fields) -> Fields:
    return {name: (member, DECIMAL_MONEY.get(name, kind)) for name, (member, kind) in fields.items()}


def parse_cdc(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split messages into (change events, dead letters); a message that is no JSON object is dead."""
    text = message_text(raw)
    # parsed once per message, see collect._parsed
    envelope = F.from_json(text, ENVELOPE, {"columnNameOfCorruptRecord": "_broken"})
    parsed = raw.select("value", text.alias("_text"), F.inline(F.array(envelope)))
    is_object = F.coalesce(F.col("_broken").isNull() & F.ltrim("_text").startswith("{"), F.lit(False))
    good = parsed.filter(is_object).select(
        F.coalesce("source.table", F.lit("unknown")).alias("table_name"),
        F.coalesce("op", F.lit("?")).alias("op"),
        "before",
        "after",
        F.coalesce("ts_ms", F.lit(0)).alias("ts_ms"),
    )
    dead = parsed.filter(~is_object).select(
        F.make_valid_utf8(F.col("value").cast("string")).alias("raw_data")
    )
    return good, dead


def cdc_operation_label(op: Column) -> Column:
    label = F.lit("UNKNOWN")
    for code, name in OPERATIONS.items():
        label = F.when(op == code, F.lit(name)).otherwise(label)
    return label


_NO_MEMBERS = r"^[ \t\r\n]*\{[ \t\r\n]*\}[ \t\r\n]*$"


def _document(text: Column) -> Column:
    """JSON text, or NULL when it is absent or an empty object, with any number of blanks."""
    return F.when(~text.rlike(_NO_MEMBERS), text)


def cdc_to_row(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Change rows of the raw layer, plus ``cols``: the members of ``after`` as a text map."""
    # the generator keeps the documents from being tested anew for every column built on them
    documents = F.struct(_document(F.col("before")).alias("_before"), _document(F.col("after")).alias("_after"))
    before, after = F.col("_before"), F.col("_after")
    return events.select("table_name", "op", "ts_ms", F.inline(F.array(documents))).select(
        F.col("table_name").alias("cdc_table"),
        cdc_operation_label(F.col("op")).alias("cdc_operation"),
        F.timestamp_millis("ts_ms").alias("cdc_timestamp"),
        before.alias("before_data"),
        after.alias("after_data"),
        F.coalesce(after, before, F.lit("{}")).alias("raw_payload"),
        (F.current_timestamp() if now is None else now).alias("ingested_at"),
        F.from_json(after, "map<string,string>").alias("cols"),
    )


def without_key(changes: DataFrame, key: str) -> DataFrame:
    """Change rows whose document does not hold the key (broken JSON, an empty object): a dead-letter output.

    ``latest_state`` ranks them together under one missing key; pass ``quarantine`` there to leave them out.
    """
    value = F.coalesce(json_scalar(F.col("after_data"), key), json_scalar(F.col("before_data"), key))
    return changes.filter(value.isNull())


def latest_state(
    changes: DataFrame,
    key: str,
    fields: Fields,
    drop_deleted: bool = False,
    now: Column | None = None,
    with_stamps: bool = True,
    quarantine: bool = False,
) -> DataFrame:
    """Current rows of one source table from its change log.

    Rows without a key make one row with a missing key; with ``quarantine`` they are left out, see ``without_key``.

    By default DELETE rows are set aside before ranking, so a deleted row shows its last live state.
    With ``drop_deleted`` they take part in the ranking and a row whose last change is a DELETE disappears.
    """
    after = F.col("after_data")
    if drop_deleted:
        key_value = F.coalesce(json_scalar(after, key), json_scalar(F.col("before_data"), key))
        live = changes
    else:
        key_value = json_scalar(after, key)
        live = changes.filter(F.col("cdc_operation") != "DELETE")
    keyed = live.select(key_value.alias("_key"), "cdc_operation", "cdc_timestamp", "ingested_at", "after_data")
    ranked = first_per_key(
        keyed.filter("_key IS NOT NULL") if quarantine else keyed,
        ["_key"],
        [F.desc("cdc_timestamp"), F.desc("ingested_at"), F.desc("after_data")],
    )
    if drop_deleted:
        ranked = ranked.filter(F.col("cdc_operation") != "DELETE")
    # one parse of the document for all columns
    members = F.from_json(after, ", ".join(f"`{member}` string" for member, _ in fields.values()))
    parsed = ranked.withColumn("_doc", members)
    columns = [typed(F.col(f"_doc.{member}"), kind).alias(name) for name, (member, kind) in fields.items()]
    if with_stamps:
        columns.append(F.col("cdc_timestamp").alias("_cdc_timestamp"))
    columns.append((F.current_timestamp() if now is None else now).alias("_etl_loaded_at"))
    return parsed.select(*columns)


def stg_orders(changes: DataFrame, drop_deleted: bool = False, now: Column | None = None) -> DataFrame:
    return latest_state(changes, "order_id", ORDER_FIELDS, drop_deleted, now)


def stg_orders_dag(changes: DataFrame, now: Column | None = None) -> DataFrame:
    names = ("order_id", "user_id", "order_status", "total_amount", "delivery_type", "ordered_at")
    return latest_state(
        changes, "order_id", {n: ORDER_FIELDS[n] for n in names}, now=now, with_stamps=False
    )


def stg_products(changes: DataFrame, drop_deleted: bool = False, now: Column | None = None) -> DataFrame:
    return latest_state(changes, "product_id", PRODUCT_FIELDS, drop_deleted, now)


def stg_order_items(changes: DataFrame, drop_deleted: bool = False, now: Column | None = None) -> DataFrame:
    return latest_state(changes, "item_id", ORDER_ITEM_FIELDS, drop_deleted, now)


def stg_users(changes: DataFrame, drop_deleted: bool = False, now: Column | None = None) -> DataFrame:
    return latest_state(changes, "user_id", USER_FIELDS, drop_deleted, now)


# Kinds of JSON members that a declared type takes; a null fits every type.
_TAKES = {
    "bigint": ("whole",),
    "double": ("fraction", "whole"),
    "string": ("text",),
    "timestamp": ("text",),
    "boolean": ("boolean",),
}


def _kind(name: Column) -> Column:
    numbers = (name == "DOUBLE") | (name == "FLOAT") | name.startswith("DECIMAL")
    return (
        F.when(name == "BIGINT", "whole")
        .when(name == "STRING", "text")
        .when(name == "BOOLEAN", "boolean")
        .when(numbers, "fraction")
        .when(name != "VOID", "nested")
    )


def document_drift(changes: DataFrame, declared: Mapping[str, Fields], unit: str = "day") -> DataFrame:
    """Members of the change documents that differ from the declared fields of their table, per table and date.

    ``new``: not declared; ``missing``: declared, in no document of that date; ``retyped``: in a form that the declared
    type does not take. ``found_kinds`` are the forms seen (null where only nulls were), ``filled`` the documents that
    hold the member. Documents are those after the change, or before it where there is none; one that is no JSON object
    has no members. Tables without a declaration, a null name among them, have new members only.

    One scan. Documents are counted by their shape (the members with their forms, once each) by hash aggregation in front of
    the shuffle; a shape is then cut into its members and itself (a null member), and what meets behind it has one row per
    table, date, member and form. The declared fields of a table join as a literal at its count of documents.
    """
    entry = "array<struct<member string, declared string, kind string, n bigint>>"
    nothing, none = F.lit(None).cast("string"), F.array().cast(entry)
    fields = []
    for table, own in declared.items():
        named = [F.struct(F.lit(m), F.lit(kind), nothing, F.lit(0).cast("bigint")) for m, kind in own.values()]
        fields += [F.lit(table), F.array(*named).cast(entry)]
    wanted = F.coalesce(F.element_at(F.create_map(*fields), F.col("cdc_table")), none) if fields else none
    members = F.from_json(F.coalesce("after_data", "before_data"), "map<string,variant>")
    # two steps: a form is derived from a name that is read off the value once
    named = F.transform(
        F.coalesce(F.map_entries(members), F.array()),
        lambda e: F.struct(e["key"].alias("member"), F.schema_of_variant(e["value"]).alias("name")),
    )
    seen = F.transform(
        named, lambda e: F.struct(e["member"].alias("member"), _kind(e["name"]).alias("kind"), F.lit(True).alias("inside"))
    )
    itself = F.struct(nothing.alias("member"), nothing.alias("kind"), F.lit(False).alias("inside"))
    date = F.to_date(F.date_trunc(unit, "cdc_timestamp")).alias("cdc_date")
    shapes = (
        changes.select("cdc_table", date, seen.alias("_shape"))
        .groupBy("cdc_table", "cdc_date", "_shape")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counted = (
        shapes.select("cdc_table", "cdc_date", "_n", F.inline(F.concat("_shape", F.array(itself))))
        .groupBy("cdc_table", "cdc_date", "member", "kind", "inside")
        .agg(F.sum("_n").alias("n"))
    )
    found = F.array(F.struct("member", nothing, "kind", "n")).cast(entry)
    merged = (
        counted.select("cdc_table", "cdc_date", F.inline(F.when(F.col("inside"), found).otherwise(wanted)))
        .groupBy("cdc_table", "cdc_date", "member")
        .agg(F.max("declared").alias("declared"), F.array_sort(F.collect_set("kind")).alias("_kinds"), F.sum("n").alias("filled"))
    )
    takes = F.create_map(*[x for name, forms in _TAKES.items() for x in (F.lit(name), F.array(*map(F.lit, forms)))])
    base = F.regexp_replace("declared", r"^decimal.*", "double")
    odd = F.size(F.array_except("_kinds", F.element_at(takes, base))) > 0
    problem = F.when(F.col("declared").isNull(), "new").when(F.col("filled") == 0, "missing").when(odd, "retyped")
    return merged.withColumn("problem", problem).filter("problem IS NOT NULL").select(
        "cdc_table",
        "cdc_date",
        "member",
        "problem",
        "declared",
        F.when(F.size("_kinds") > 0, F.concat_ws(",", "_kinds")).alias("found_kinds"),
        "filled",
    )
