"""Consent state, its audit history and the fail-closed gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsefeed.functions.times import utc_date
from pulsefeed.schemas import CONSENT

USER = "user_pseudo_id"


def current_consent(changes: DataFrame) -> DataFrame:
    """Last write per user wins. ``changes``: user_pseudo_id, consent_granted, ts, seq."""
    return (
        changes.groupBy(USER)
        .agg(F.max_by(F.struct("consent_granted", "ts"), F.struct("ts", "seq")).alias("last"))
        .select(USER, F.col("last.consent_granted").alias("consent_granted"), F.col("last.ts").alias("updated_at"))
    )


def merge_consent(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Upsert newer decisions into the snapshot; replaying a batch changes nothing."""
    both = snapshot.unionByName(current_consent(changes))
    return (
        both.groupBy(USER)
        .agg(F.max_by(F.struct("consent_granted", "updated_at"), F.col("updated_at")).alias("last"))
        .select(USER, "last.*")
    )


def audit_entries(changes: DataFrame) -> DataFrame:
    """One GRANT or REVOKE entry per call, also when nothing changed."""
    return changes.select(
        F.col("seq").alias("id"),
        USER,
        F.when(F.col("consent_granted"), "GRANT").otherwise("REVOKE").alias("action"),
        F.col("ts").alias("timestamp"),
        "reason",
    )


def audit_mismatch(consent: DataFrame, audit: DataFrame) -> DataFrame:
    """Users whose consent differs from their newest audit entry; empty by invariant."""
    newest = audit.groupBy(USER).agg(
        F.max_by(F.struct("action", "timestamp"), F.struct("timestamp", "id")).alias("last")
    ).select(USER, (F.col("last.action") == "GRANT").alias("consent_granted"), F.col("last.timestamp").alias("updated_at"))
    return consent.join(newest, [USER, "consent_granted", "updated_at"], "left_anti")


def audit_history(audit: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Entries newest first within a user, numbered; unknown users yield nothing."""
    chosen = audit if users is None else audit.join(users, USER, "left_semi")
    return chosen.orderBy(USER, F.desc("timestamp"), F.desc("id"))


def consent_gate(users: DataFrame, consent: DataFrame, user: str = USER) -> DataFrame:
    """Users with granted: true only for an explicit grant."""
    state = consent.select(F.col(USER).alias(user), F.col("consent_granted").alias("_granted"))
    return users.join(state, user, "left").withColumn(
        "granted", F.coalesce("_granted", F.lit(False))
    ).drop("_granted")


def read_consent(spark: SparkSession, load: Callable[[], DataFrame]) -> DataFrame:
    """The consent snapshot, or an empty one (everybody denied) when it cannot be read."""
    try:
        found = load()
        return found.select(*CONSENT.fieldNames())
    except AnalysisException:
        return spark.createDataFrame([], CONSENT)


def revocations(audit: DataFrame) -> DataFrame:
    return (
        audit.filter(F.col("action") == "REVOKE")
        .groupBy(utc_date(F.unix_micros("timestamp")).alias("day"))
        .agg(F.count("*").alias("revocations"), F.countDistinct(USER).alias("users"))
    )


def audit_month(ts: Column) -> Column:
    """Calendar month in UTC, whatever the session zone."""
    return F.substring(utc_date(F.unix_micros(ts)), 1, 7)
