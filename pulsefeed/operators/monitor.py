"""Latency, error, freshness and lag reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.operators.evaluation import index_percentiles

_PERCENTS = [50, 95, 99]


def endpoint_stats(log: DataFrame) -> DataFrame:
    """Per endpoint: requests, errors and index percentiles of the latency.

    A request without a latency, a time-out, counts as a request; one without an
    outcome counts as an error.
    """
    totals = {"requests": F.lit(1), "errors": (~F.coalesce(F.col("ok"), F.lit(False))).cast("bigint")}
    return index_percentiles(log, ["endpoint"], "latency_ms", _PERCENTS, totals).drop("n")


def _suites(suites: dict[str, tuple[float, float]]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("suite"), F.lit(float(p95)).alias("max_p95_ms"), F.lit(float(err)).alias("max_error_pct")
            )
            for name, (p95, err) in suites.items()
        ]
    )


def slo_summary(stats: DataFrame, *more: Column) -> DataFrame:
    """Overall figures: worst endpoint for the tails, median endpoint for p50; and ``more`` aggregates of the endpoints."""
    return stats.agg(
        F.coalesce(F.sum("requests"), F.lit(0)).alias("requests"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        F.coalesce(F.percentile("p50", 0.5), F.lit(0.0)).alias("p50_ms"),
        F.coalesce(F.max("p95"), F.lit(0.0)).alias("p95_ms"),
        F.coalesce(F.max("p99"), F.lit(0.0)).alias("p99_ms"),
        *more,
    ).withColumn(
        "error_pct",
        F.when(F.col("requests") > 0, F.col("errors") / F.col("requests") * 100.0).otherwise(F.lit(0.0)),
    )


def _judged(summary: DataFrame, suites: dict[str, tuple[float, float]] | None) -> DataFrame:
    """The summary against each suite's thresholds; reaching a threshold exactly passes."""
    latency_ok = F.col("p95_ms") <= F.col("max_p95_ms")
    errors_ok = F.col("error_pct") <= F.col("max_error_pct")
    return summary.select("*", F.inline(_suites(suites or cfg.SLO_SUITES))).withColumns(
        {"latency_passed": latency_ok, "errors_passed": errors_ok, "passed": latency_ok & errors_ok}
    )


def slo_report(log: DataFrame, suites: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    return _judged(slo_summary(endpoint_stats(log)), suites).select(
        "suite", "requests", "errors", "p50_ms", "p95_ms", "p99_ms", "error_pct", "latency_passed", "errors_passed", "passed"
    )


def slo_snapshot(log: DataFrame, suites: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """The report with its thresholds and the figures of each endpoint, one pass over the log.

    Endpoints are the service's routes, so their figures fit a row; requests
    without one are an endpoint of their own, last in order.
    """
    rate = F.col("errors") / F.col("requests") * 100.0
    figures = F.struct(
        F.col("endpoint").isNull().alias("unnamed"), "endpoint", "requests", "errors", rate.alias("error_pct"),
        F.col("p50").alias("p50_ms"), F.col("p95").alias("p95_ms"), F.col("p99").alias("p99_ms"),
    )
    shown = F.transform(F.sort_array(F.collect_list(figures)), lambda f: f.dropFields("unnamed"))
    report = _judged(slo_summary(endpoint_stats(log), shown.alias("endpoints")), suites)
    limits = F.struct("max_p95_ms", "max_error_pct").alias("thresholds")
    return report.select(
        "suite", "requests", "errors", "p50_ms", "p95_ms", "p99_ms", "error_pct", "latency_passed", "errors_passed", "passed", limits, "endpoints"
    )


def feature_age(latest: DataFrame, as_of: Column) -> Column:
    return as_of - F.col("computed_at_epoch")


def freshness_report(rows: DataFrame, as_of: Column, limit: float = cfg.FRESHNESS_LIMIT_SECONDS) -> DataFrame:
    """Age of feature rows at ``as_of`` and how many reach the limit."""
    age = as_of - F.col("computed_at_epoch")
    return rows.agg(
        F.count("*").alias("n"),
        F.min(age).alias("min_age"),
        F.avg(age).alias("avg_age"),
        F.max(age).alias("max_age"),
        F.sum((age >= limit).cast("bigint")).alias("breaches"),
    )


def processing_lag(rows: DataFrame, by: str = "event_date") -> DataFrame:
    """Event time to compute time, index percentiles per day."""
    lag = rows.select(by, (F.col("computed_at_epoch") - F.col("last_event_epoch")).alias("lag_s"))
    return index_percentiles(lag, [by], "lag_s", _PERCENTS)
