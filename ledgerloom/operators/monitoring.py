"""Outbox lag, latency service levels and benchmark metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How old a pending event may be, how many may be late, the latency bound,
# the load tester's sum row and the text of the alert.
LAG_MINUTES = 5
LAG_ALERT_ABOVE = 1000
SLA_MS = 500
TOTALS_ROW = "Aggregated"


def pending_events(outbox: DataFrame) -> DataFrame:
    return outbox.filter(~F.col("processed"))


def outbox_lag(outbox: DataFrame, as_of: datetime, minutes: int = LAG_MINUTES, threshold: int = LAG_ALERT_ABOVE) -> DataFrame:
    """One row: how many events wait longer than allowed, and whether that calls for an alert."""
    stamp = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(outbox.schema["created_at"].dataType)
    late = pending_events(outbox).filter(F.col("created_at") < stamp - F.expr(f"interval {minutes} minutes"))
    return late.agg(F.count("*").alias("lag")).withColumn("alert", F.col("lag") > threshold)


def latency_report(requests: DataFrame, sla_ms: float = SLA_MS) -> DataFrame:
    """Calls, failures, median, 99th percentile and verdict per request name.

    Requests are first counted per name and exact latency, so the percentile of
    a hot name holds one entry per distinct latency, not per request.
    """
    counted = (
        requests.filter(~F.col("name").eqNullSafe(F.lit(TOTALS_ROW)))
        .groupBy("name", F.col("ms").cast("double").alias("ms"))
        .agg(F.count("*").alias("_n"), F.count_if("failed").alias("_failed"))
    )
    summary = counted.groupBy("name").agg(
        F.sum("_n").alias("total_calls"),
        F.sum("_failed").alias("failures"),
        F.percentile("ms", [0.5, 0.99], F.col("_n")).alias("_q"),
    )
    return _verdicts(
        summary.select("name", "total_calls", "failures", F.col("_q")[0].alias("median_ms"), F.col("_q")[1].alias("p99_ms")), sla_ms
    )


def latency_report_from_stats(stats: DataFrame, sla_ms: float = SLA_MS) -> DataFrame:
    """The same report from a load tester's per-name CSV; unreadable percentiles are flagged."""
    renamed = stats.filter(~F.col("Name").eqNullSafe(F.lit(TOTALS_ROW))).select(
        F.coalesce("Name", F.lit("Unknown")).alias("name"),
        F.coalesce(F.col("Request Count").try_cast("bigint"), F.lit(0)).alias("total_calls"),
        F.coalesce(F.col("Failure Count").try_cast("bigint"), F.lit(0)).alias("failures"),
        F.col("Median Response Time").try_cast("double").alias("median_ms"),
        F.col("`99%`").try_cast("double").alias("p99_ms"),
    )
    return _verdicts(renamed, sla_ms)


def _verdicts(summary: DataFrame, sla_ms: float) -> DataFrame:
    share = F.col("failures").cast("double") / F.nullif(F.col("total_calls").cast("double"), F.lit(0.0)) * 100
    verdict = (
        F.when(F.col("p99_ms").isNull(), F.lit("UNPARSED"))
        .when(F.col("p99_ms") > sla_ms, F.lit("WARNING"))
        .otherwise(F.lit("PASS"))
    )
    return summary.select("name", "total_calls", "failures", share.alias("failure_pct"), "median_ms", "p99_ms", verdict.alias("verdict"))


def metrics_by_run(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Metric rows with the scenario of their run; a run without metrics is kept."""
    return runs.join(metrics, "run_id", "left").select("run_id", "scenario_name", "metric_name", "metric_value", "metric_unit")
