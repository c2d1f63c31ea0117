"""Model versions, aliases and promotion over an append-only registry table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsefeed import settings as cfg


def current_aliases(assignments: DataFrame) -> DataFrame:
    """Version each (model, alias) points at: the latest assignment wins."""
    return (
        assignments.groupBy("name", "alias")
        .agg(F.max_by("version", F.struct("assigned_at", "version")).alias("version"))
    )


def resolve(assignments: DataFrame, aliases: list[str] | None = None) -> DataFrame:
    """Per model, the version under the first alias that exists; models with none are absent."""
    wanted = aliases or cfg.MODEL_ALIASES
    rank = None
    for i, alias in enumerate(wanted):
        hit = F.col("alias") == alias
        rank = F.when(hit, F.lit(i)) if rank is None else rank.when(hit, F.lit(i))
    return (
        current_aliases(assignments)
        .withColumn("_rank", rank)
        .filter(F.col("_rank").isNotNull())
        .groupBy("name")
        .agg(F.min_by(F.struct("alias", "version"), "_rank").alias("m"))
        .select("name", "m.alias", "m.version")
    )


def promotion_candidates(versions: DataFrame, minimums: dict[str, float]) -> DataFrame:
    """Versions whose every listed metric exceeds its minimum."""
    out = versions
    for metric, minimum in minimums.items():
        out = out.filter(F.col(metric) > F.lit(minimum))
    return out
