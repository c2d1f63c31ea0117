"""Dropping replayed feature rows from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsefeed.operators.dedup import KEY


def drop_replays(rows: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per (user, event time) among rows arriving within ``delay`` of each other.

    The stream keeps the first copy it sees, since it cannot take a row back; the
    batch form keeps the newest. State is dropped once the watermark on the
    compute time has passed a key by ``delay``. Spark keeps this operator's state in
    its own row format only, so the session's encoding is set back to that.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.encodingFormat", "unsaferow")
    clocked = rows.withColumn("_computed", F.timestamp_seconds("computed_at_epoch"))
    return clocked.withWatermark("_computed", delay).dropDuplicatesWithinWatermark(KEY).drop("_computed")
