"""Boundary checks, the message parser and the privacy projection.

Every check is a column expression naming the first failed rule, so one pass
over the input yields both the accepted rows and the rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed.functions.pseudonym import pseudonymize
from pulsefeed.functions.times import epoch_us, iso_text, local_event_date, parse_boundary_time, parse_iso
from pulsefeed.schemas import MESSAGE_REQUIRED, SESSION_INPUT, WATCH_INPUT, WATCH_MESSAGE

REASON = "reject_reason"


def _first_failure(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds; a rule that is NULL does not hold."""
    out = None
    for name, failed in rules:
        out = F.when(failed, F.lit(name)) if out is None else out.when(failed, F.lit(name))
    return out


def _in_percent(value: Column) -> Column:
    # NaN sorts above every number, so it fails the upper bound.
    return (value >= 0.0) & (value <= 100.0)


# --- API boundary -----------------------------------------------------------------


def check_watch(raw: DataFrame) -> DataFrame:
    """Raw watch input plus reject_reason (NULL when valid). Numeric text is accepted."""
    pct = F.col("watch_pct").try_cast("double")
    missing = [(f"missing_{c}", F.col(c).isNull()) for c in ["user_id", "content_id", "watch_pct", "timestamp"]]
    return raw.withColumn(
        REASON,
        _first_failure(
            missing
            + [
                ("watch_pct_not_a_number", pct.isNull()),
                ("watch_pct_out_of_range", ~_in_percent(pct)),
                ("bad_timestamp", parse_boundary_time(F.col("timestamp")).isNull()),
            ]
        ),
    )


def check_session(raw: DataFrame) -> DataFrame:
    missing = [(f"missing_{c}", F.col(c).isNull()) for c in SESSION_INPUT.fieldNames()]
    return raw.withColumn(
        REASON, _first_failure(missing + [("bad_start_time", parse_boundary_time(F.col("start_time")).isNull())])
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def rejects_by_reason(checked: DataFrame) -> DataFrame:
    return rejected(checked).groupBy(REASON).agg(F.count("*").alias("n"))


def watch_payload(valid: DataFrame, secret: str, extra: list[str] | None = None) -> DataFrame:
    """What may leave the boundary: the raw user id is replaced, never carried, and the time is ISO-8601 whatever form it had."""
    return valid.select(
        pseudonymize(F.col("user_id"), secret).alias("pseudo_user_id"),
        "content_id",
        F.col("watch_pct").cast("double").alias("watch_pct"),
        iso_text(F.col("timestamp")).alias("timestamp"),
        *[c for c in WATCH_INPUT.fieldNames() if c in ("genre", "timezone")],
        *(extra or []),
    )


def session_payload(valid: DataFrame, secret: str, extra: list[str] | None = None) -> DataFrame:
    return valid.select(
        pseudonymize(F.col("user_id"), secret).alias("pseudo_user_id"),
        "session_id",
        "device",
        iso_text(F.col("start_time")).alias("start_time"),
        *(extra or []),
    )


def sessions_per_device(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("device").agg(
        F.count("*").alias("sessions"), F.countDistinct("pseudo_user_id").alias("users")
    )


# --- message parser -----------------------------------------------------------------


def check_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages with their parsed fields and reject_reason.

    Order of the rules: not JSON, not an object, a required key absent (a null
    value is present), null key, percentage not a bare number in [0, 100],
    timestamp not ISO-8601.
    """
    text = F.col(value)
    # One-element arrays: a filter on the reason is not pushed below an explode,
    # so each message is parsed once however often its fields are used.
    decoded = messages.select(
        "*",
        F.explode(F.array(F.struct(F.json_object_keys(text).alias("keys"), F.from_json(text, WATCH_MESSAGE).alias("m")))).alias("_p"),
    )
    m = lambda c: F.col(f"_p.m.{c}")
    timed = decoded.select(
        "*", F.explode(F.array(F.struct(parse_iso(m("timestamp")).alias("ts")))).alias("_t")
    )
    keys = F.col("_p.keys")
    absent = F.lit(False)
    for key in MESSAGE_REQUIRED:
        absent = absent | ~F.array_contains(keys, key)
    reason = _first_failure(
        [
            ("not_json", keys.isNull() & F.try_parse_json(text).isNull()),
            ("not_an_object", keys.isNull()),
            ("missing_field", absent),
            ("null_key", m("pseudo_user_id").isNull()),
            # A quoted number or a boolean is NULL under a DOUBLE schema.
            ("bad_watch_pct", m("watch_pct").isNull() | ~_in_percent(m("watch_pct"))),
            ("bad_timestamp", F.col("_t.ts").isNull()),
        ]
    )
    return timed.withColumn(REASON, reason).select(
        *messages.columns, "_p.m.*", F.col("_t.ts").alias("event_ts"), REASON
    )


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Accepted messages as watch events; arrival columns pass through if present."""
    passing = [c for c in messages.columns if c != value]
    return (
        accepted(check_messages(messages, value))
        .select(
            "pseudo_user_id",
            "content_id",
            "watch_pct",
            "genre",
            "timezone",
            epoch_us(F.col("event_ts")).alias("event_us"),
            local_event_date(F.col("timestamp")).alias("event_date"),
            *passing,
        )
    )
