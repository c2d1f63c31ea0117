"""Monthly partitions of the audit log: bounds, expiry, archive and drop."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.operators.consent import audit_month
from pulsefeed.schemas import AUDIT_LOG
from pulsefeed.sources import files
from pulsefeed.sources.batch_log import BatchLog

MONTH = "audit_month"


def first_of_month(day: Column, shift: int = 0) -> Column:
    return F.add_months(F.trunc(day, "MM"), shift)


def month_bounds(months: DataFrame, lookahead: int = cfg.AUDIT_LOOKAHEAD_MONTHS) -> DataFrame:
    """[start, end) of each month in use and of the next ``lookahead`` months."""
    start = F.to_date(F.concat(F.col(MONTH), F.lit("-01")))
    ahead = F.explode(F.sequence(F.lit(0), F.lit(lookahead))).alias("shift")
    shifted = months.select(start.alias("start"), ahead).select(
        F.expr("add_months(start, shift)").alias("from_date")
    )
    return shifted.distinct().select(
        F.date_format("from_date", "yyyy-MM").alias(MONTH),
        F.date_format("from_date", "yyyy-MM-dd").alias("from_date"),
        F.date_format(F.add_months("from_date", 1), "yyyy-MM-dd").alias("to_date"),
    )


def retention_cutoff(as_of: Column, keep_months: int = cfg.AUDIT_RETENTION_MONTHS) -> Column:
    """First month kept: the current month and ``keep_months`` before it survive."""
    return F.date_format(first_of_month(as_of, -keep_months), "yyyy-MM")


def with_month(audit: DataFrame) -> DataFrame:
    return audit.withColumn(MONTH, audit_month(F.col("timestamp")))


def expired_months(audit: DataFrame, as_of: Column, keep_months: int = cfg.AUDIT_RETENTION_MONTHS) -> DataFrame:
    return (
        with_month(audit)
        .filter(F.col(MONTH) < retention_cutoff(as_of, keep_months))
        .groupBy(MONTH)
        .agg(F.count("*").alias("entries"))
    )


def retained(audit: DataFrame, as_of: Column, keep_months: int = cfg.AUDIT_RETENTION_MONTHS) -> DataFrame:
    return with_month(audit).filter(F.col(MONTH) >= retention_cutoff(as_of, keep_months))


def write_audit(audit: DataFrame, path: str, mode: str = "append") -> None:
    with_month(audit).write.partitionBy(MONTH).mode(mode).parquet(path)


def audit_log(spark: SparkSession, path: str) -> BatchLog:
    return BatchLog(spark, path, AUDIT_LOG, [MONTH])


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The partitioned log; months stay text so that filters on them prune directories."""
    return audit_log(spark, path).read()


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """Month directories of the log, from the file listing alone (bounded by months)."""
    return files.partition_values(spark, path, MONTH)


def drop_expired(
    spark: SparkSession,
    path: str,
    as_of: dt.date,
    keep_months: int = cfg.AUDIT_RETENTION_MONTHS,
    archive: str | None = None,
    dry_run: bool = False,
) -> list[str]:
    """Delete month directories past retention; returns the months concerned.

    With ``archive``, the rows of a month that the archive lacks are added to it
    first, and the month is only deleted once it lacks none: rows that arrive late
    for an archived month join the earlier ones, and a repeated run adds nothing
    twice. Whole directories go: no data file is rewritten.
    """
    index = as_of.year * 12 + as_of.month - 1 - keep_months
    cutoff = f"{index // 12:04d}-{index % 12 + 1:02d}"
    months = [m for m in stored_months(spark, path) if m < cutoff]
    if dry_run:
        return months
    log = audit_log(spark, path)
    for month in months:
        if archive is not None:
            target = f"{archive}/{MONTH}={month}"
            rows = log.read([f"{MONTH}={month}"]).select(*AUDIT_LOG.fieldNames())
            kept = lambda: spark.read.schema(AUDIT_LOG).parquet(target)
            missing = rows.exceptAll(kept()) if files.exists(spark, target) else rows
            missing.write.mode("append").parquet(target)
            if not rows.exceptAll(kept()).isEmpty():
                raise RuntimeError(f"archive of {month} is incomplete; nothing was deleted")
        log.drop(f"{MONTH}={month}")
    return months
