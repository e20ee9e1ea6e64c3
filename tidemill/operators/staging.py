"""Raw event logs to de-duplicated staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exprs import Day, days_before, flag
from tidemill.functions.keyed import first_per_key
from tidemill.operators.taxonomy import parse_taxonomy

_USER_EVENT_COLUMNS = (
    "event_id", "event_type", "event_timestamp", "user_id", "session_id", "device_type", "page_url", "referrer",
    "utm_source", "utm_medium", "utm_campaign", "properties", "ingested_at",
)


def stg_user_events(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per event id: the one ingested last. Ties are broken on every other column."""
    rows = raw.select(*_USER_EVENT_COLUMNS)
    rest = [F.asc(c) for c in _USER_EVENT_COLUMNS if c not in ("event_id", "ingested_at")]
    kept = first_per_key(rows, ["event_id"], [F.desc("ingested_at"), *rest])
    return kept.withColumn("_etl_loaded_at", F.current_timestamp() if now is None else now)


def stg_user_events_distinct(raw: DataFrame) -> DataFrame:
    """Rows that differ in at least one column."""
    return raw.distinct()


def stg_events(raw: DataFrame, as_of: Day, lookback_days: int = 90) -> DataFrame:
    """Payment-app events: real users, well-formed names, recent days, one row per event id (the earliest).

    ``_`` in the two LIKE patterns is a wildcard, so ``testX1`` is a test user as well; a NULL user is dropped.
    """
    first = days_before(as_of, lookback_days)
    kept = parse_taxonomy(
        raw.filter(~F.col("user_id").like("test_%") & ~F.col("user_id").like("internal_%")).filter(
            F.col("event_timestamp") >= first.cast("timestamp")
        )
    )
    deduped = first_per_key(
        kept.filter("is_valid").drop("is_valid"),
        ["event_id"],
        [F.asc("_ingested_at"), F.asc("event_timestamp"), F.asc("session_id"), F.asc("event_name")],
    )
    return deduped.select(
        "event_id", "event_name", "event_timestamp", "user_id", "session_id", "device_id", "device_type",
        "app_version", "os_version", "screen_name", "event_category", "event_action", "event_label",
        "properties", "_ingested_at",
    )


def stg_transactions(events: DataFrame) -> DataFrame:
    """Payments and transfers, one row per (transaction, event name), positive amounts only.

    The amount is tested after the first row per key is chosen, so a zero first delivery hides a later one.
    Both kinds share one scan and one de-duplication: the kind is part of the key.
    """
    p = "properties."
    payment = F.col("event_category") == "payment"
    name = F.col("event_name")
    payment_status = (
        F.when(name == "payment.complete.payment_success", "COMPLETED")
        .when(name == "payment.complete.refund", "REFUNDED")
        .when(name == "payment.fail.payment_error", "FAILED")
        .otherwise("UNKNOWN")
    )
    transfer_status = (
        F.when(name.like("%complete%"), "COMPLETED").when(name.like("%fail%"), "FAILED").otherwise("UNKNOWN")
    )
    rows = (
        events.filter(F.col("event_category").isin("payment", "transfer"))
        .select(
            "event_timestamp",
            "user_id",
            "session_id",
            F.when(payment, F.col(p + "transaction_id")).otherwise(F.col(p + "transfer_id")).alias("transaction_id"),
            F.col(p + "amount").alias("amount"),
            F.when(payment, F.col(p + "payment_method")).otherwise("transfer").alias("payment_method"),
            F.when(payment, F.col(p + "merchant_id")).alias("merchant_id"),
            F.when(payment, F.col(p + "merchant_category")).alias("merchant_category"),
            F.when(payment, F.col(p + "is_first_payment")).otherwise(F.lit(False)).alias("is_first_payment"),
            "event_name",
            F.when(payment, payment_status).otherwise(transfer_status).alias("transaction_status"),
            "event_id",
            flag(payment).alias("_kind"),
        )
        .filter(F.col("transaction_id").isNotNull())
    )
    first = first_per_key(
        rows, ["transaction_id", "event_name", "_kind"], [F.asc("event_timestamp"), F.asc("event_id")]
    )
    return first.filter(F.col("amount") > 0).drop("event_id", "_kind")


def logins(events: DataFrame) -> DataFrame:
    """Completed logins of known users: the basis of every activity and retention metric."""
    return events.filter(
        (F.col("event_name") == "auth.complete.login") & ~F.col("user_id").like("anonymous_%")
    )
