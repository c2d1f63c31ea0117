"""Consent changes as a stream: current state and audit log from the same batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from pulsefeed.operators.consent import audit_entries
from pulsefeed.operators import retention
from pulsefeed.operators.retention import with_month
from pulsefeed.schemas import CONSENT
from pulsefeed.sources.latest_table import LatestTable, stream_run

_STATE = T.StructType(CONSENT.fields + [T.StructField("seq", T.LongType())])


def consent_table(spark: SparkSession, path: str) -> LatestTable:
    return LatestTable(spark, path, _STATE, "user_pseudo_id", ["updated_at", "seq"])


def change_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Consent changes from JSON lines."""
    reader = spark.readStream.schema("user_pseudo_id string, consent_granted boolean, reason string, ts timestamp, seq long")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def consent_writer(
    changes: DataFrame, table: LatestTable, audit_path: str, checkpoint: str, compact_every: int = 50
) -> DataStreamWriter:
    """Write both tables per batch, the audit log first.

    Both writes are named after the stream run and the batch and replace
    themselves when it is repeated, so after a failure in between the retry brings
    them back in step, and a new checkpoint never meets the entries of an old one.
    Both are compacted now and then; the audit log month by month.
    """
    audit = retention.audit_log(changes.sparkSession, audit_path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Two writes read the batch: keep it so that the source is read once.
        batch.persist()
        run = stream_run(batch)
        audit.append(with_month(audit_entries(batch)), batch_id, run)
        table.upsert(batch.withColumnRenamed("ts", "updated_at"), batch_id, run)
        batch.unpersist()
        if batch_id and batch_id % compact_every == 0:
            table.compact()
            audit.compact(max(2, compact_every // 2))

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def read_audit_log(spark: SparkSession, audit_path: str) -> DataFrame:
    return retention.audit_log(spark, audit_path).read()
