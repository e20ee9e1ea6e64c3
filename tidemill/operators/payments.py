"""Payment app: sessions, payment funnels, net revenue."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.exprs import Day, any_flag, as_json, between_days, day, flag, pct, ratio, whole_seconds
from tidemill.functions.keyed import top_per_key

# Event names of the payment flow.
LOGIN = "auth.complete.login"
CHECKOUT = "payment.view.checkout_screen"
SELECT = "payment.click.payment_method_select"
SUBMIT = "payment.submit.payment_request"
SUCCESS = "payment.complete.payment_success"
REFUND = "payment.complete.refund"
TRANSFER_DONE = "transfer.complete.to_account"


def _named(name: str) -> Column:
    return F.col("event_name") == name


def _in(category: str, action: str) -> Column:
    return (F.col("event_category") == category) & (F.col("event_action") == action)


def int_user_sessions(events: DataFrame) -> DataFrame:
    """One row per session, user and device with step flags."""
    start, end = F.min("event_timestamp"), F.max("event_timestamp")
    return events.groupBy("session_id", "user_id", "device_type").agg(
        start.alias("session_start"),
        end.alias("session_end"),
        whole_seconds(start, end).alias("session_duration_sec"),
        F.count(F.lit(1)).alias("total_events"),
        any_flag(_named(LOGIN)).alias("has_login"),
        any_flag(_in("payment", "view")).alias("has_payment_view"),
        any_flag(_named(SELECT)).alias("has_method_select"),
        any_flag(_named(SUBMIT)).alias("has_payment_submit"),
        any_flag(_named(SUCCESS)).alias("has_payment_complete"),
        any_flag(F.col("event_name").like("payment.fail.%")).alias("has_payment_fail"),
        any_flag(_in("transfer", "view")).alias("has_transfer_view"),
        any_flag(_named(TRANSFER_DONE)).alias("has_transfer_complete"),
        any_flag(F.col("event_category") == "error").alias("has_error"),
    )


def mart_payment_funnel(sessions: DataFrame) -> DataFrame:
    """Funnel of sessions that reached a payment screen, per day and device."""
    totals = (
        sessions.filter(F.col("has_payment_view") == 1)
        .groupBy(F.to_date("session_start").alias("dt"), "device_type")
        .agg(
            F.count_distinct("session_id").alias("total_sessions"),
            F.sum("has_payment_view").alias("step1_payment_view"),
            F.sum("has_method_select").alias("step2_method_select"),
            F.sum("has_payment_submit").alias("step3_payment_submit"),
            F.sum("has_payment_complete").alias("step4_payment_complete"),
            F.sum("has_payment_fail").alias("payment_fail_sessions"),
        )
    )
    view, select, submit, done = (
        F.col(c)
        for c in ("step1_payment_view", "step2_method_select", "step3_payment_submit", "step4_payment_complete")
    )
    return (
        totals.withColumn("cvr_view_to_select", pct(select, view))
        .withColumn("cvr_select_to_submit", pct(submit, select))
        .withColumn("cvr_submit_to_complete", pct(done, submit))
        .withColumn("overall_payment_cvr", pct(done, view))
        .withColumn("payment_failure_rate", pct(F.col("payment_fail_sessions"), submit))
    )


def payment_funnel_dropoff(events: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """Payment funnel with its largest drop-off over the last full days."""
    last = day(as_of)
    start, end = F.min("event_timestamp"), F.max("event_timestamp")
    sessions = (
        events.filter(
            (F.col("event_category") == "payment")
            & between_days("event_timestamp", last - timedelta(days=days), last - timedelta(days=1))
        )
        .groupBy("session_id", "user_id", "device_type")
        .agg(
            F.to_date(start).alias("dt"),
            any_flag(F.col("event_name").like("payment.view.%")).alias("funnel_view"),
            any_flag(_named(SELECT)).alias("funnel_select"),
            any_flag(_named(SUBMIT)).alias("funnel_submit"),
            any_flag(_named(SUCCESS)).alias("funnel_complete"),
            any_flag(F.col("event_name").like("payment.fail.%")).alias("failed"),
            whole_seconds(start, end).alias("seconds"),
        )
    )
    steps = ("funnel_view", "funnel_select", "funnel_submit", "funnel_complete")
    totals = sessions.groupBy("dt", "device_type").agg(
        *[F.sum(s).alias(s) for s in steps],
        F.avg(F.when(F.col("funnel_complete") == 1, F.col("seconds"))).alias("avg_completion_time_sec"),
        pct(F.sum("failed"), F.count(F.lit(1))).alias("error_session_pct"),
    )
    v, s, r, c = (F.col(n) for n in steps)
    return (
        totals.withColumn("cvr_1to2_pct", pct(s, v))
        .withColumn("cvr_2to3_pct", pct(r, s))
        .withColumn("cvr_3to4_pct", pct(c, r))
        .withColumn("overall_cvr_pct", pct(c, v))
        .withColumn("max_dropoff_count", F.greatest(v - s, s - r, r - c))
        .orderBy(F.desc("dt"), "device_type")
    )


def net_payments(events: DataFrame) -> DataFrame:
    """One row per paid transaction: the earliest success, minus the sum of its refunds.

    Success and refunds of a transaction meet in one aggregation, so there is one scan, one shuffle and no
    join; both sides are reduced before the shuffle, however often an id repeats.
    """
    p = "properties."
    paid = _named(SUCCESS) & (F.col(p + "amount") > 0)
    payload = F.struct(
        "event_timestamp",
        "event_id",
        "user_id",
        F.col(p + "amount").alias("gross"),
        F.col(p + "payment_method").alias("payment_method"),
        F.col(p + "merchant_category").alias("merchant_category"),
        F.col(p + "is_first_payment").alias("is_first_payment"),
    )
    per_id = (
        events.filter(F.col(p + "transaction_id").isNotNull() & (paid | _named(REFUND)))
        .groupBy(F.col(p + "transaction_id").alias("transaction_id"))
        .agg(
            F.min(F.when(paid, payload)).alias("_pay"),
            F.coalesce(F.sum(F.when(_named(REFUND), F.col(p + "amount"))), F.lit(0)).alias("refund"),
        )
        .filter(F.col("_pay").isNotNull())
    )
    return per_id.select(
        "transaction_id",
        F.to_date("_pay.event_timestamp").alias("dt"),
        F.col("_pay.user_id").alias("user_id"),
        F.col("_pay.gross").alias("gross"),
        "refund",
        (F.col("_pay.gross") - F.col("refund")).alias("net"),
        F.col("_pay.payment_method").alias("payment_method"),
        F.col("_pay.merchant_category").alias("merchant_category"),
        F.col("_pay.is_first_payment").alias("is_first_payment"),
    )


def _payer_totals(net: DataFrame, period: str, methods: Sequence[str]) -> DataFrame:
    """Per period: users and sums over rows with a positive net, and net per method over all rows.

    Reducing to one row per user first makes every distinct user count a plain count.
    """
    good = F.col("net") > 0
    sums = ("txns", "gross", "refunds", "net_pos", "net_all")
    per_user = net.groupBy(period, "user_id").agg(
        F.sum(flag(good)).alias("txns"),
        F.sum(F.when(good, F.col("gross")).otherwise(0)).alias("gross"),
        F.sum(F.when(good, F.col("refund")).otherwise(0)).alias("refunds"),
        F.sum(F.when(good, F.col("net")).otherwise(0)).alias("net_pos"),
        F.sum("net").alias("net_all"),
        any_flag(good).alias("payer"),
        any_flag(good & F.col("is_first_payment")).alias("first_payer"),
        *[F.sum(flag(good & (F.col("payment_method") == m))).alias(f"n_{m}") for m in methods],
        *[
            F.sum(F.when(F.col("payment_method") == m, F.col("net")).otherwise(0)).alias(f"net_{m}")
            for m in methods
        ],
    )
    known = F.col("user_id").isNotNull()
    return (
        per_user.groupBy(period)
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            F.sum(F.when(known, F.col("payer")).otherwise(0)).alias("paying_users"),
            F.sum(F.when(known, F.col("first_payer")).otherwise(0)).alias("new_payers"),
            *[F.sum(f"n_{m}").alias(f"n_{m}") for m in methods],
            *[F.sum(f"net_{m}").alias(f"net_{m}") for m in methods],
        )
        .filter(F.col("txns") > 0)
    )


def revenue_analysis(events: DataFrame, methods: Sequence[str] = ("card", "app_balance")) -> DataFrame:
    """Daily net revenue with change to the previous row, 7-row mean and revenue share per method.

    The shares use every net payment of the day, also the negative ones; the other metrics only positive net.
    The two ordered windows run over one row per day.
    """
    d = _payer_totals(net_payments(events), "dt", methods)
    by_day = Window.orderBy("dt")
    previous = F.lag("net_pos").over(by_day)
    return d.select(
        "dt",
        "paying_users",
        F.col("txns").alias("txn_count"),
        F.col("gross").alias("gross_revenue"),
        F.col("refunds").alias("total_refund"),
        F.col("net_pos").alias("net_revenue"),
        ratio(F.col("net_pos"), F.col("paying_users")).alias("arppu"),
        ratio(F.col("net_pos"), F.col("txns")).alias("avg_txn_amount"),
        "new_payers",
        pct(F.col("net_pos") - previous, previous).alias("revenue_change_pct"),
        F.avg("net_pos").over(by_day.rowsBetween(-6, 0)).alias("revenue_7d_ma"),
        *[pct(F.col(f"net_{m}"), F.col("net_all")).alias(f"{m}_revenue_pct") for m in methods],
    ).orderBy(F.desc("dt"))


def _arppu(net: DataFrame, period: str, methods: Sequence[str]) -> DataFrame:
    d = _payer_totals(net, period, methods)
    return d.select(
        period,
        "paying_users",
        F.col("txns").alias("total_transactions"),
        F.col("gross").alias("gross_revenue"),
        F.col("refunds").alias("total_refunds"),
        F.col("net_pos").alias("net_revenue"),
        ratio(F.col("net_pos"), F.col("paying_users")).alias("arppu"),
        ratio(F.col("net_pos"), F.col("txns")).alias("avg_transaction_amount"),
        pct(F.col("new_payers"), F.col("paying_users")).alias("first_payment_user_pct"),
        *[pct(F.col(f"n_{m}"), F.col("txns")).alias(f"{m}_pct") for m in methods],
    ).orderBy(F.desc(period))


def arppu_daily(events: DataFrame, methods: Sequence[str] = ("card", "app_balance")) -> DataFrame:
    """Average revenue per paying user per day; refunds are summed per transaction before they are deducted."""
    return _arppu(net_payments(events), "dt", methods)


def arppu_monthly(events: DataFrame, methods: Sequence[str] = ("card", "app_balance")) -> DataFrame:
    """The same per calendar month, with payers counted once per month."""
    net = net_payments(events).withColumn("month", F.trunc("dt", "month"))
    return _arppu(net, "month", methods)


def mart_revenue(
    transactions: DataFrame,
    top_n: int = 5,
    methods: Sequence[str] = ("card", "bank_transfer", "app_balance"),
) -> DataFrame:
    """Daily revenue from completed payments net of refunds, with the largest payments of the day as JSON.

    Refunds reach their payment through a window over the transaction id: one shuffle, and at most a few rows
    per id after staging. The top list keeps ``top_n`` rows per day already in front of its shuffle. Day totals and
    top list start from the same columns behind a generator, which keeps each from being pruned to its own: the input is
    read and shuffled once, and the second reader reuses it.
    """
    refunded = F.col("transaction_status") == "REFUNDED"
    sold = (F.col("transaction_status") == "COMPLETED") & (F.col("payment_method") != "transfer")
    by_id = Window.partitionBy("transaction_id")
    net = (
        transactions.filter(refunded | sold)
        .select(
            F.to_date("event_timestamp").alias("dt"),
            "user_id",
            "transaction_id",
            "amount",
            "payment_method",
            "merchant_category",
            "is_first_payment",
            F.coalesce(sold, F.lit(False)).alias("_sold"),
            F.coalesce(F.sum(F.when(refunded, F.col("amount"))).over(by_id), F.lit(0)).alias("refund"),
        )
        .filter("_sold")
        .withColumn("net", F.col("amount") - F.col("refund"))
        .withColumnRenamed("amount", "gross")
        .filter(F.col("net") > 0)
    )
    net = net.select(F.inline(F.array(F.struct(*[c for c in net.columns if c != "_sold"]))))
    d = _payer_totals(net, "dt", methods)
    best = top_per_key(
        net.select("dt", "net", "merchant_category", "transaction_id"),
        ["dt"],
        [F.desc("net"), F.asc_nulls_last("merchant_category"), F.asc("transaction_id")],
        top_n,
    )
    entry = F.struct("_rank", F.struct("merchant_category", F.col("net").alias("net_amount")).alias("e"))
    ranked = F.array_sort(F.collect_list(entry))
    tops = best.groupBy("dt").agg(
        as_json(F.transform(ranked, lambda x: x["e"])).alias("top_merchant_categories")
    )
    return d.join(tops, "dt", "left").select(
        "dt",
        "paying_users",
        F.col("txns").alias("total_transactions"),
        F.col("gross").alias("gross_revenue"),
        F.col("refunds").alias("total_refunds"),
        F.col("net_pos").alias("net_revenue"),
        ratio(F.col("net_pos"), F.col("paying_users")).alias("arppu"),
        ratio(F.col("net_pos"), F.col("txns")).alias("avg_txn_amount"),
        F.col("new_payers").alias("new_paying_users"),
        pct(F.col("new_payers"), F.col("paying_users")).alias("new_paying_user_pct"),
        *[pct(F.col(f"n_{m}"), F.col("txns")).alias(f"{m}_pct") for m in methods],
        "top_merchant_categories",
    )


def payment_method_mix(transactions: DataFrame) -> DataFrame:
    """Share of completed transactions and of their amount per day and payment method."""
    per_method = (
        transactions.filter(F.col("transaction_status") == "COMPLETED")
        .groupBy(F.to_date("event_timestamp").alias("dt"), "payment_method")
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("revenue"))
    )
    of_day = Window.partitionBy("dt")
    return per_method.withColumn(
        "transaction_share_pct", pct(F.col("transactions"), F.sum("transactions").over(of_day))
    ).withColumn("revenue_share_pct", pct(F.col("revenue"), F.sum("revenue").over(of_day)))


# ---- data tests: every returned row is a failure


def check_unique_transaction(transactions: DataFrame) -> DataFrame:
    """Completed transaction ids that occur more than once."""
    return (
        transactions.filter(F.col("transaction_status") == "COMPLETED")
        .groupBy("transaction_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .filter(F.col("cnt") > 1)
    )


def check_revenue_not_negative(revenue: DataFrame) -> DataFrame:
    """Days with a negative gross or net revenue."""
    return revenue.filter((F.col("net_revenue") < 0) | (F.col("gross_revenue") < 0)).select(
        "dt", "net_revenue", "gross_revenue", "total_refunds"
    )


def check_arppu_reasonable(revenue: DataFrame, as_of: Day, days: int = 30, sigma: float = 3.0) -> DataFrame:
    """Yesterday's ARPPU when it lies more than ``sigma`` deviations from the mean of the last ``days`` days.

    One aggregation over one row per day gives the statistics and the tested value together.
    """
    last = day(as_of)
    tested = F.lit(last - timedelta(days=1))
    z = ratio(F.abs(F.col("arppu") - F.col("avg_arppu")), F.nullif(F.col("std_arppu"), F.lit(0.0)))
    return (
        revenue.filter(F.col("dt") >= F.lit(last - timedelta(days=days)))
        .agg(
            F.avg("arppu").alias("avg_arppu"),
            F.stddev("arppu").alias("std_arppu"),
            F.max(F.when(F.col("dt") == tested, F.col("arppu"))).alias("arppu"),
        )
        .select(tested.alias("dt"), "arppu", "avg_arppu", "std_arppu", z.alias("z_score"))
        .filter(F.col("z_score") > sigma)
    )
