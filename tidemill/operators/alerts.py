"""What happens after a suite ran: failed rules, routing, summaries, scores. All inputs are rule results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default route of each priority: (channel, action). Pass your own to ``dq_failures``.
ROUTES = {"P0": ("critical", "halt"), "P1": ("alerts", "review"), "P2": ("summary", "report")}


def _route(priority: Column, routes: Mapping[str, tuple[str, str]], position: int) -> Column:
    value = F.lit(None).cast("string")
    for name, entry in routes.items():
        value = F.when(priority == name, F.lit(entry[position])).otherwise(value)
    return value


def dq_failures(results: DataFrame, routes: Mapping[str, tuple[str, str]] = ROUTES) -> DataFrame:
    """Failed rules with the worst priority of their suite, its route, and whether the suite must halt."""
    worst = F.min("priority").over(Window.partitionBy("suite"))
    return (
        results.filter(~F.col("success"))
        .withColumn("max_priority", worst)
        .select(
            "suite", "rule_no", "expectation", "column", "priority", "category", "observed_value",
            "element_count", "unexpected_percent", "max_priority",
            _route(F.col("max_priority"), routes, 0).alias("channel"),
            _route(F.col("max_priority"), routes, 1).alias("action"),
            (F.col("max_priority") == "P0").alias("should_halt"),
        )
    )


def should_halt(results: DataFrame) -> bool:
    """True when a P0 rule failed."""
    return bool(results.agg(F.count_if(~F.col("success") & (F.col("priority") == "P0")) > 0).first()[0])


def dq_daily_summary(results: DataFrame) -> DataFrame:
    """One row: suites, passed and failed suites, failed rules."""
    per_suite = results.groupBy("suite").agg(F.count_if(~F.col("success")).alias("failures"))
    return per_suite.agg(
        F.count(F.lit(1)).alias("total_suites"),
        F.count_if(F.col("failures") == 0).alias("passed_suites"),
        F.count_if(F.col("failures") > 0).alias("failed_suites"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("failed_rules"),
    )


def dq_alert_branch(results: DataFrame) -> DataFrame:
    """One row: the branch to take."""
    any_failure = F.count_if(~F.col("success")) > 0
    return results.agg(F.when(any_failure, "send_critical_alert").otherwise("send_summary").alias("branch"))


def quality_scorecard(results: DataFrame) -> DataFrame:
    """Score per rule category (mean share of good rows; a rule about a single value is 100 or 0) and overall."""
    score = F.coalesce(
        F.lit(100.0) - F.col("unexpected_percent"), F.when(F.col("success"), 100.0).otherwise(0.0)
    )
    per_rule = results.select("category", "success", score.alias("score"))
    labels = F.explode(F.array(F.col("category"), F.lit("overall")))
    return (
        per_rule.withColumn("category", labels)
        .groupBy("category")
        .agg(
            F.avg("score").alias("score"),
            F.count(F.lit(1)).alias("rules"),
            F.count_if(~F.col("success")).alias("failed_rules"),
        )
    )
