"""Deduplication of replayed feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["pseudo_user_id", "last_event_epoch"]


def dedup_feature_rows(rows: DataFrame) -> DataFrame:
    """One row per (user, event time): the newest computation, then the fullest window.

    The remaining columns break exact ties, so a replay gives the same row.
    """
    rest = [c for c in rows.columns if c not in KEY]
    rank = ["computed_at_epoch", "watch_count_10min"]
    best = F.struct(*rank, *[c for c in rest if c not in rank])
    return rows.groupBy(*KEY).agg(F.max(best).alias("row")).select(*KEY, "row.*").select(*rows.columns)
