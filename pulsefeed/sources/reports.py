"""Request logs in, report snapshots out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsefeed.operators.monitor import slo_snapshot
from pulsefeed.schemas import REQUEST_LOG


def read_request_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(REQUEST_LOG)
    return reader.csv(path, header=True) if fmt == "csv" else reader.parquet(path)


def write_slo_snapshot(log: DataFrame, path: str, suites: dict[str, tuple[float, float]] | None = None) -> None:
    """Append one JSON row per suite with its thresholds and the endpoints' figures, stamped with the time of the report."""
    report = slo_snapshot(log, suites).withColumn("ran_at", F.current_timestamp())
    report.coalesce(1).write.mode("append").json(path)


def latest_snapshot(spark: SparkSession, path: str, suite: str) -> DataFrame:
    """Newest report row of a suite (empty if it never ran)."""
    return spark.read.json(path).filter(F.col("suite") == suite).orderBy(F.desc("ran_at")).limit(1)
