"""Payment-app event names and message schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.collect import _errors, message_text

# Name pattern, required keys, allowed keys and enumerations of the message schema.
NAME_PATTERN = r"^[a-z_]+\.[a-z_]+\.[a-z_]+$"
VERSION_PATTERN = r"^\d+\.\d+\.\d+$"
DATE_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}"
UUID_PATTERN = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
TEXT_PROPERTIES = (
    "transaction_id", "merchant_id", "merchant_category", "transfer_id", "from_account_type", "to_account_type",
    "error_code", "error_message",
)
REQUIRED = (
    "event_id", "event_name", "event_timestamp", "user_id", "session_id", "device_id", "device_type", "app_version",
)
OPTIONAL = ("os_version", "screen_name", "properties")
OTHER_PROPERTIES = ("amount", "payment_method", "is_first_payment")
DEVICES = ("ios", "android", "web")
PAYMENT_METHODS = ("card", "bank_transfer", "app_balance")

NOT_SURELY_TEXT = r"^(-?\d+(\.\d+)?([eE][+-]?\d+)?$|true$|false$|[{\[])"


def parse_taxonomy(events: DataFrame) -> DataFrame:
    """Split ``category.action.label`` and mark names that do not follow the pattern."""
    parts = F.split("event_name", "[.]")
    return (
        events.withColumn("event_category", F.get(parts, F.lit(0)))
        .withColumn("event_action", F.get(parts, F.lit(1)))
        .withColumn("event_label", F.get(parts, F.lit(2)))
        .withColumn("is_valid", F.coalesce(F.col("event_name").rlike(NAME_PATTERN), F.lit(False)))
    )


def validate_event_schema(
    raw: DataFrame, payment_methods: tuple[str, ...] = PAYMENT_METHODS, check_formats: bool = False
) -> DataFrame:
    """Add ``errors`` to JSON messages: the keys that break the message schema, by presence, type, pattern or range.

    A required key that is missing or null is reported under its own name. ``unknown_key`` stands for any top-level key
    outside the schema. ``not_an_object`` stands alone: nothing else can be judged then (a key given twice counts as that).
    With ``check_formats`` the event id must be a UUID too. A message is parsed once, typed.
    """
    # Generators keep later steps from being folded into earlier ones: the text is parsed once, each member read once.
    parsed = raw.select("*", F.inline(F.array(F.struct(F.try_parse_json(message_text(raw)).alias("_v")))))
    read = {"_m": F.try_variant_get("_v", "$", "map<string,string>")}
    read["_p"] = F.try_variant_get("_v", "$.properties", "map<string,string>")
    read["_properties"] = F.try_variant_get("_v", "$.properties", "variant")
    read["_number"] = F.try_variant_get("_v", "$.properties.amount", "double")
    parsed = parsed.select(*raw.columns, "_v", F.inline(F.array(F.struct(*[c.alias(n) for n, c in read.items()]))))

    def found(path: str) -> Column:
        return F.col("_p")[path.removeprefix("properties.")] if path.startswith("properties.") else F.col("_m")[path]

    def typed(path: str) -> Column:
        """Only a text that could be a number, a truth value or a nested value as well is looked up again for its type."""
        of_variant = F.schema_of_variant(F.try_variant_get("_v", f"$.{path}", "variant"))
        unsure = found(path).rlike(NOT_SURELY_TEXT)
        return F.when(found(path).isNull(), "VOID").when(unsure, F.coalesce(of_variant, F.lit("VOID"))).otherwise("STRING")

    paths = [*REQUIRED, *OPTIONAL[:2], *[f"properties.{n}" for n in (*TEXT_PROPERTIES, *OTHER_PROPERTIES)]]
    parsed = _in_steps(parsed, {f"_k_{p.replace('.', '_')}": typed(p) for p in paths})

    def kind(path: str) -> Column:
        return F.col(f"_k_{path.replace('.', '_')}")

    def text(path: str) -> Column:
        return F.when(kind(path) == "STRING", found(path))

    def optional(path: str, of_kind: Column) -> Column:
        return (kind(path) == "VOID") | of_kind

    rules = {name: F.length(text(name)) >= 1 for name in REQUIRED}
    if check_formats:
        rules["event_id"] = text("event_id").rlike(UUID_PATTERN)
    stamp = text("event_timestamp")
    rules["event_name"] = text("event_name").rlike(NAME_PATTERN)
    rules["event_timestamp"] = stamp.rlike(DATE_TIME_PATTERN) & F.try_to_timestamp(stamp).isNotNull()
    rules["device_type"] = text("device_type").isin(*DEVICES)
    rules["app_version"] = text("app_version").rlike(VERSION_PATTERN)
    for name in ("os_version", "screen_name"):
        rules[name] = optional(name, kind(name) == "STRING")
    rules["properties"] = F.col("_properties").isNull() | F.col("_p").isNotNull()
    for name in TEXT_PROPERTIES:
        rules[name] = optional(f"properties.{name}", kind(f"properties.{name}") == "STRING")
    number = F.col("_number")
    whole = kind("properties.amount").rlike("^(BIGINT|DECIMAL|DOUBLE)") & (number == F.floor(number)) & (number >= 0)
    rules["amount"] = optional("properties.amount", whole)
    rules["payment_method"] = optional("properties.payment_method", text("properties.payment_method").isin(*payment_methods))
    rules["is_first_payment"] = optional("properties.is_first_payment", kind("properties.is_first_payment") == "BOOLEAN")
    known = F.array(*[F.lit(k) for k in (*REQUIRED, *OPTIONAL)])
    rules["unknown_key"] = F.size(F.array_except(F.map_keys("_m"), known)) == 0
    parsed = _in_steps(parsed, {f"_r_{n}": ok for n, ok in rules.items()})
    broken = _errors({n: F.col(f"_r_{n}") for n in rules})
    errors = F.when(F.col("_m").isNull(), F.array(F.lit("not_an_object"))).otherwise(broken)
    return parsed.select(*raw.columns, errors.alias("errors"))


def _in_steps(df: DataFrame, columns: dict[str, Column], width: int = 4) -> DataFrame:
    """Adds columns a few at a time, each step behind a generator: one step becomes one method of generated code, and the
    JVM does not compile methods beyond a certain length."""
    names = list(columns)
    for a in range(0, len(names), width):
        some = F.struct(*[columns[n].alias(n) for n in names[a : a + width]])
        df = df.select("*", F.inline(F.array(some)))
    return df
