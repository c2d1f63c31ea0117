"""Offline feature log: hive-partitioned Parquet by event date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsefeed.schemas import ARRIVAL, FEATURE_COLUMNS, FEATURE_ROW
from pulsefeed.sources import files
from pulsefeed.sources.batch_log import BatchLog

PARTITIONS = ["year", "month", "day"]
# Files written by the stream also hold the arrival position. Partition values
# are declared as text: inference would read month=05 as 5.
LOG_SCHEMA = T.StructType(
    FEATURE_ROW.fields
    + [T.StructField(c, T.LongType(), True) for c in ARRIVAL]
    + [T.StructField(p, T.StringType(), True) for p in PARTITIONS]
)


def with_partitions(rows: DataFrame) -> DataFrame:
    """Feature rows with year, month and day taken from their event date."""
    return rows.select(
        *FEATURE_COLUMNS,
        *[c for c in ARRIVAL if c in rows.columns],
        F.substring("event_date", 1, 4).alias("year"),
        F.substring("event_date", 6, 2).alias("month"),
        F.substring("event_date", 9, 2).alias("day"),
    )


def write_log(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows to the log; a batch may span days.

    The rebalance gathers each day's rows into few files and, by size at run
    time, spreads a heavy day over many writers.
    """
    laid_out = with_partitions(rows).hint("rebalance", *PARTITIONS)
    laid_out.write.partitionBy(*PARTITIONS).mode(mode).option("compression", "snappy").parquet(path)


def _day_path() -> Column:
    return F.concat_ws("-", *PARTITIONS)


def days_between(stored: list[str], low: str, high: str) -> list[str]:
    """The day directories within [low, high]."""
    day = lambda p: "-".join(x.split("=", 1)[1] for x in p.split("/"))
    return [p for p in stored if low <= day(p) <= high]


def file_outcomes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, length, rows, error) of every data file below ``paths``, each read whole in a task.

    ``error`` says why a file, or a part of it, cannot be read; ``rows`` counts what can be up to there.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(paths)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, length, content in zip(*(batch[c] for c in ("path", "length", "content"))):
                rows, error = 0, None
                try:
                    parquet = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                    for group in range(parquet.num_row_groups):
                        rows += sum(part.num_rows for part in parquet.iter_batches(row_groups=[group]))
                except Exception as failure:  # whatever the reader meets is the finding
                    error = f"{type(failure).__name__}: {failure}"[:500]
                yield pa.RecordBatch.from_pydict(
                    {"file": [file.as_py()], "length": [length.as_py()], "rows": [rows], "error": pa.array([error], pa.string())}
                )

    return found.select("path", "length", "content").mapInArrow(check, "file string, length long, rows long, error string")


def read_log(
    spark: SparkSession, path: str, date_from: str | dt.date, date_to: str | dt.date, skip_corrupt: bool = True,
    report: str | None = None,
) -> DataFrame:
    """Rows with event dates in [date_from, date_to]; missing days are skipped.

    Only the directories of those days are read. No row at all is an error: training on an empty set
    must not pass silently. Unreadable files are skipped like missing days; with
    ``report`` every file is read once before, and those that cannot be read whole
    are appended there with the reason, and left out as a whole.
    """
    low, high = str(date_from), str(date_to)
    reader = spark.read.schema(LOG_SCHEMA)
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    found = None
    if files.exists(spark, f"{path}/_spark_metadata"):
        # The file sink's own list says which of its files count.
        found = reader.parquet(path).filter(_day_path().between(low, high)).select(*FEATURE_COLUMNS)
    elif files.exists(spark, path):
        log = batch_log(spark, path)
        options = {"ignoreCorruptFiles": "true"} if skip_corrupt else {}
        days = days_between(log.stored(), low, high)
        found = log.read(days, **options).filter(_day_path().between(low, high))
        if report is not None and days:
            bad = file_outcomes(spark, [p.removesuffix("/*.parquet") for d in days for p in log.live(d)]).filter("error IS NOT NULL")
            bad.withColumn("read_at", F.current_timestamp()).write.mode("append").parquet(report)
            plain = lambda c: F.regexp_replace(c, r"^(\w+):/+", "$1:/")
            bad = spark.read.parquet(report).select(plain(F.col("file")).alias("_bad")).distinct()
            found = found.withColumn("_file", plain(F.input_file_name())).join(bad, F.col("_file") == F.col("_bad"), "left_anti")
        found = found.select(*FEATURE_COLUMNS)
    if found is None or found.isEmpty():
        raise ValueError(f"no readable feature log rows in {path!r} between {low} and {high}")
    return found


def batch_log(spark: SparkSession, path: str) -> BatchLog:
    """The log as micro-batches write it: rows with their arrival position, a directory per day and batch, compacted."""
    fields = FEATURE_ROW.fields + [T.StructField(c, T.LongType(), True) for c in ARRIVAL]
    return BatchLog(spark, path, T.StructType(fields), PARTITIONS)


def rows_in_range(rows: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """The same range on a table that is not partitioned by date."""
    return rows.filter(F.col("event_date").between(date_from, date_to))


def partition_counts(rows: DataFrame) -> DataFrame:
    return with_partitions(rows).groupBy(*PARTITIONS).agg(F.count("*").alias("n"))
