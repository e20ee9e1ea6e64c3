"""The daily jobs: raw to staging to mart, and the payment metrics with their quality gates."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.functions.exprs import Day
from tidemill.operators import alerts, behaviour, changes, checks, engagement, payments, rules, sales, staging
from tidemill.plans.lake import Lake
from tidemill.session import settings
from tidemill.streaming.ledger import StreamTable
from tidemill.streaming.sinks import filesystem

RUN_LOG = (
    "pipeline_name string, table_name string, status string, rows_processed bigint, duration_sec double, error_type string"
)


# Shuffle files go when the statement that wrote them ends, not when the driver happens to collect its garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


class QualityGateFailure(RuntimeError):
    """A rule of the highest priority failed; nothing after the gate may run."""


class RunLog:
    """Collects one entry per step and appends them to the monitoring layer."""

    def __init__(self, lake: Lake, job: str) -> None:
        self.lake, self.job, self.entries = lake, job, []
        self.seen: dict[str, Observation] = {}

    def count(self, table: str, frame: DataFrame) -> DataFrame:
        """The frame, whose rows are counted when it is stored; the step of that table takes this count."""
        self.seen[table] = Observation()
        return frame.observe(self.seen[table], F.count(F.lit(1)).alias("rows"))

    def step(self, table: str, frame: DataFrame, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
        started = time.perf_counter()
        try:
            result = write(frame if table in self.seen else self.count(table, frame))
        except Exception as error:
            self._add(table, "error", 0, started, type(error).__name__)
            self.save()
            raise
        self._add(table, "success", int(self.seen.pop(table).get["rows"]), started, None)
        return result

    def together(self, steps: Sequence[tuple[str, DataFrame, Callable[[DataFrame], DataFrame]]]) -> list[DataFrame]:
        """Steps that read none of each other's tables, side by side: the tasks of one take the cores that another leaves idle.

        Entries keep the given order. Every step runs to its end; then the first error in that order is raised.
        """
        parts = [_Part(self.lake, self.job) for _ in steps]
        with ThreadPoolExecutor(len(steps)) as pool:
            # wrapped one by one: each thread needs a copy of the local properties for itself
            inherit = [inheritable_thread_target(self.lake.spark)(part.step) for part in parts]
            runs = [pool.submit(run, *step) for run, step in zip(inherit, steps)]
        for part in parts:
            self.entries += part.entries
        if any(run.exception() for run in runs):
            self.save()
        return [run.result() for run in runs]

    def _add(self, table: str, status: str, rows: int, started: float, error: str | None) -> None:
        self.entries.append((self.job, table, status, rows, time.perf_counter() - started, error))

    def fail(self, table: str, error: str) -> None:
        """Record a step that stopped the run without an exception of its own."""
        self._add(table, "error", 0, time.perf_counter(), error)

    def frame(self) -> DataFrame:
        return self.lake.spark.createDataFrame(self.entries, RUN_LOG)

    def save(self) -> None:
        self.lake.append(self.frame().coalesce(1), "monitoring", "run_log")


class _Part(RunLog):
    """One of several steps side by side; the log that it is part of saves its entry."""

    def save(self) -> None:
        pass


def run_batch(
    lake: Lake,
    cdc_orders: DataFrame,
    cdc_products: DataFrame,
    cdc_order_items: DataFrame,
    cdc_users: DataFrame,
    user_events: DataFrame,
) -> RunLog:
    """Rebuild the shop staging tables side by side, then the marts from the stored staging tables."""
    log = RunLog(lake, "daily_batch")

    def store(layer: str, frames: dict[str, DataFrame]) -> list[DataFrame]:
        return log.together([(name, df, lambda df, name=name: lake.store(df, layer, name)) for name, df in frames.items()])

    staged = {
        "orders": changes.stg_orders(cdc_orders),
        "products": changes.stg_products(cdc_products),
        "order_items": changes.stg_order_items(cdc_order_items),
        "users": changes.stg_users(cdc_users),
        "user_events": staging.stg_user_events(user_events),
    }
    orders, products, items, _, events = store("staging", staged)
    marts = {
        "daily_sales": sales.mart_daily_sales(orders, items, products),
        "daily_funnel": behaviour.mart_daily_funnel(events),
    }
    store("mart", marts)
    log.save()
    return log


def run_batch_since(
    lake: Lake,
    cdc_orders: DataFrame,
    cdc_products: DataFrame,
    cdc_order_items: DataFrame,
    cdc_users: DataFrame,
    user_events: DataFrame,
    unfinished: str | None = None,
) -> RunLog:
    """Bring staging tables and marts up to date with the changes and events since the last run.

    The result equals ``run_batch`` over everything. Only the partitions that hold changed keys are rewritten, and only the
    mart dates whose orders, items or product groups changed are computed again. What these were before the merge is kept
    under ``unfinished`` where that is given: a run that follows a stopped one finds there what the stored tables no longer tell.

    Disk holds what the run still needs: rows put aside go with the run, shuffle files with the step that wrote them.
    """
    logs = (cdc_orders, cdc_products, cdc_order_items, cdc_users)
    with settings(lake.spark, DROP_SHUFFLES), lake.passing() as aside:
        return _batch_since(lake, aside, *logs, user_events, unfinished)


def _batch_since(
    lake: Lake,
    aside: Callable[[DataFrame, str], DataFrame],
    cdc_orders: DataFrame,
    cdc_products: DataFrame,
    cdc_order_items: DataFrame,
    cdc_users: DataFrame,
    user_events: DataFrame,
    unfinished: str | None,
) -> RunLog:
    log = RunLog(lake, "daily_batch")
    stamp = ["_cdc_timestamp"]

    def changed(name: str, frame: DataFrame) -> DataFrame:
        """Rows stored once, in the form of their table: they are read several times below and by the merge."""
        return aside(lake.shaped(log.count(name, frame), "staging", name), f"{name}-changed")

    def merge(name: str, frame: DataFrame, key: str, order: list[str], stored: bool = True) -> DataFrame:
        return log.step(name, frame, lambda df: lake.merge(df, "staging", name, [key], order, stored))

    new_orders = changed("orders", changes.stg_orders(cdc_orders))
    new_items = changed("order_items", changes.stg_order_items(cdc_order_items))
    new_products = changed("products", changes.stg_products(cdc_products))

    def before_merge(name: str, frame: DataFrame) -> DataFrame:
        if unfinished is None:
            return aside(frame.distinct(), name)
        frame.distinct().write.mode("append").parquet(f"{unfinished}/{name}")
        return lake.spark.read.schema(frame.schema).parquet(f"{unfinished}/{name}").distinct()

    # what is needed of the state before
    date = F.to_date("ordered_at").alias("d")
    earlier = lake.read("staging", "orders").join(new_orders.select("order_id"), "order_id", "left_semi").select(date)
    earlier = before_merge("dates-before", earlier)
    moved_items = lake.read("staging", "order_items").join(new_items.select("item_id"), "item_id", "left_semi")
    group = F.struct("category_l1", "storage_type")
    before = lake.read("staging", "products").select("product_id", group.alias("_before"))
    regrouped = new_products.select("product_id", group.alias("_after")).join(before, "product_id", "left")
    regrouped = before_merge("regrouped", regrouped.filter(~F.col("_after").eqNullSafe(F.col("_before"))).select("product_id"))
    ids = new_orders.select("order_id").unionByName(new_items.select("order_id")).unionByName(moved_items.select("order_id"))
    ids = before_merge("orders-touched", ids)

    orders = merge("orders", new_orders, "order_id", stamp)
    products = merge("products", new_products, "product_id", stamp)
    items = merge("order_items", new_items, "item_id", stamp)
    merge("users", changes.stg_users(cdc_users), "user_id", stamp, stored=False)
    new_events = changed("user_events", staging.stg_user_events(user_events))
    events = merge("user_events", new_events, "event_id", ["ingested_at"])

    ids = ids.unionByName(items.join(regrouped, "product_id", "left_semi").select("order_id")).distinct()
    dates = orders.join(ids, "order_id", "left_semi").select(date).unionByName(earlier).distinct()
    dates = aside(dates, "dates-touched")
    of_dates = orders.join(dates, F.to_date("ordered_at").eqNullSafe(F.col("d")), "left_semi")
    sold = sales.mart_daily_sales(of_dates, items.join(of_dates.select("order_id"), "order_id", "left_semi"), products)
    log.step("daily_sales", sold, lambda df: lake.replace_dates(df, "mart", "daily_sales", "order_date", dates))
    days = new_events.select(F.to_date("event_timestamp").alias("d")).distinct()
    seen = events.join(days, F.to_date("event_timestamp").eqNullSafe(F.col("d")), "left_semi")
    funnel = behaviour.mart_daily_funnel(seen)
    log.step("daily_funnel", funnel, lambda df: lake.replace_dates(df, "mart", "daily_funnel", "event_date", days))
    log.save()
    return log


def run_batch_from_streams(lake: Lake, changes: StreamTable, events: StreamTable, reader: str = "daily_batch") -> RunLog:
    """``run_batch_since`` over the batches that streams confirmed since this job's last run.

    The marks of the ledger move once everything is stored. A run that was lost before that is repeated over the same batches
    and later ones: merging a row again changes nothing.
    """
    spark, unfinished = lake.spark, f"{lake.root}/_unfinished/{reader}"
    lake.bootstrap_layers()
    upto = {table: table.confirmed(spark) for table in (changes, events)}
    rows = {table: table.between(spark, table.taken(spark, reader), last) for table, last in upto.items()}
    logs = [rows[changes].filter(F.col("cdc_table") == name) for name in ("orders", "products", "order_items", "users")]
    log = run_batch_since(lake, *logs, rows[events], unfinished)
    for table, last in upto.items():
        if last >= 0:
            table.take(spark, reader, last)
    path, fs = filesystem(spark, unfinished)
    fs.delete(path, True)
    return log


def run_quality_checks(lake: Lake, results: DataFrame) -> RunLog:
    """Store check records (``checks.dq_run_all``), then stop with an error if a critical one failed."""
    log = RunLog(lake, "data_quality")

    def store(df: DataFrame) -> DataFrame:
        lake.sink_quality_results(df)
        return df

    stored = log.step("data_quality_checks", lake.aside(results, "checks"), store)
    try:
        checks.raise_on_critical(stored)
    except checks.CriticalQualityFailure as failure:
        log.fail("quality_gate", str(failure))
        raise
    finally:
        log.save()
    return log


def update_login_days(lake: Lake, staged: DataFrame) -> DataFrame:
    """Adds the logins of newly staged payment events to the stored days of each user; the same rows again change nothing.

    The table has one row per user, so it is rewritten whole; the rows are stored aside first. A login that staging takes
    back later stays until the table is built anew.
    """
    new = engagement.login_days(staged)
    if lake.exists("staging", "login_days"):
        new = lake.aside(engagement.merge_login_days(lake.read("staging", "login_days"), new), "login-days")
    return lake.store(new, "staging", "login_days")


def run_payment_metrics(lake: Lake, raw_events: DataFrame, as_of: Day, gate: bool = True) -> RunLog:
    """Build the payment marts from transactions stored once, behind the transaction rules.

    Staged events and transactions are written before anything reads them: every mart then starts from a
    columnar table instead of repeating the de-duplication.
    """
    log = RunLog(lake, "payment_metrics")

    def table(
        layer: str, name: str, frame: DataFrame, partition: str | None = None, cluster: tuple[str, ...] = ()
    ) -> DataFrame:
        return log.step(
            name, frame, lambda df: lake.materialize_model(df, name, "table", partition, cluster, layer)
        )

    staged = staging.stg_events(raw_events, as_of).withColumn("event_date", F.to_date("event_timestamp"))
    events = table("staging", "stg_events", staged, "event_date")
    txns = staging.stg_transactions(events).withColumn("event_date", F.to_date("event_timestamp"))
    transactions = table("staging", "stg_transactions", txns, "event_date")
    results = rules.dq_suite_run(transactions, rules.transactions_suite(), "transactions_suite")
    stored = table("monitoring", "suite_results", results)
    if gate and alerts.should_halt(stored):
        log.fail("quality_gate", "a P0 transaction rule failed")
        log.save()
        raise QualityGateFailure("a P0 transaction rule failed")
    sessions = payments.int_user_sessions(events)
    table("mart", "mart_payment_funnel", payments.mart_payment_funnel(sessions), cluster=("dt",))
    table("mart", "mart_revenue", payments.mart_revenue(transactions), cluster=("dt",))
    table("mart", "mart_user_retention", engagement.mart_user_retention(events, as_of), cluster=("cohort_date",))
    log.save()
    return log
