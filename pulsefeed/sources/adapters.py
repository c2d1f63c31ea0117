"""Interaction tables derived from the benchmark's ``events`` table.

The table has no genre, zone or lateness, so these are fixed functions of its
columns. Everything below is a projection: no shuffle, columns pruned at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.functions.pseudonym import pseudonymize
from pulsefeed.functions.times import DAY_US, HOUR_US, utc_date

# Zone by user_id % 5; the null and the unknown name exercise the UTC fallback.
ZONES = ["America/New_York", "Asia/Kolkata", "Not/ATimezone", None, "Europe/London"]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with integer microseconds in place of the zone-less timestamp."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    # TIMESTAMP_NTZ holds UTC wall time; the difference to the epoch is exact.
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return raw.withColumn("t_us", micros).withColumn("user_id", F.col("user_id").cast("string"))


def _pick(values: list[str | None], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def watch_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw watch events as a client would send them (unvalidated)."""
    position = F.col("event_id") % len(cfg.CATALOG)
    genre = (
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .when(F.col("event_type") == "signup", F.lit(""))
        .otherwise(_pick([c[1] for c in cfg.CATALOG], position))
    )
    return read_events(spark, sf_dir).select(
        "event_id",
        "user_id",
        _pick([c[0] for c in cfg.CATALOG], position).alias("content_id"),
        F.col("value").alias("watch_pct"),
        F.col("t_us").alias("event_us"),
        genre.alias("genre"),
        _pick(ZONES, F.col("user_id").cast("bigint") % len(ZONES)).alias("timezone"),
        (F.col("t_us") + (F.col("event_id") % 7) * F.lit(6 * HOUR_US)).alias("arrival_us"),
    )


def watch_events(spark: SparkSession, sf_dir: str, secret: str | None = None) -> DataFrame:
    """Valid, pseudonymized watch events with their arrival position."""
    valid = watch_input(spark, sf_dir).filter(F.col("watch_pct").between(0.0, 100.0))
    return valid.select(
        pseudonymize(F.col("user_id"), secret or cfg.pseudonym_secret()).alias("pseudo_user_id"),
        "content_id",
        "watch_pct",
        "genre",
        "timezone",
        "event_us",
        utc_date(F.col("event_us")).alias("event_date"),
        "arrival_us",
        F.col("event_id").alias("arrival_seq"),
    )


def boundary_stamps() -> Column:
    """The event time in the forms a client may send: full, unix seconds, unix milliseconds, basic with an offset, naive."""
    wall = lambda pattern: F.date_format("ts", pattern)
    micros = F.col("t_us")
    forms = [
        wall("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        F.format_string("%d.%06d", F.floor(micros / 1_000_000), F.pmod(micros, F.lit(1_000_000))),
        F.floor(micros / 1_000).cast("string"),
        wall("yyyyMMdd'T'HHmmss.SSSSSS'+0530'"),
        wall("yyyy-MM-dd HH:mm:ss,SSSSSS"),
    ]
    return F.element_at(F.array(*forms), (F.col("event_id") % len(forms) + 1).cast("int"))


def raw_watch_input(spark: SparkSession, sf_dir: str, stamp: Column | None = None) -> DataFrame:
    """Watch events as untyped text with every kind of invalid row among them."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") if stamp is None else stamp
    events = read_events(spark, sf_dir)
    n = F.col("event_id")
    return events.select(
        "event_id",
        F.when(n % 97 != 0, F.col("user_id")).alias("user_id"),
        F.when(n % 89 != 0, _pick([c[0] for c in cfg.CATALOG], n % len(cfg.CATALOG))).alias("content_id"),
        F.when(n % 83 == 0, F.lit("abc")).when(n % 79 != 0, F.col("value").cast("string")).alias("watch_pct"),
        F.when(n % 73 == 0, F.lit("not-a-date"))
        .otherwise(stamp).alias("timestamp"),
        F.lit(None).cast("string").alias("genre"),
        F.lit(None).cast("string").alias("timezone"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages; eleven in sixteen event ids carry one kind of defect or oddity."""
    kind = F.col("event_id") % 16
    user = F.when(kind == 3, F.lit("null")).otherwise(F.concat(F.lit('"u'), F.col("user_id"), F.lit('"')))
    content = F.when(kind == 8, F.lit("null")).otherwise(
        F.concat(F.lit('"'), _pick([c[0] for c in cfg.CATALOG], F.col("event_id") % len(cfg.CATALOG)), F.lit('"'))
    )
    value = F.col("value").cast("string")
    pct = F.when(kind == 4, F.concat(F.lit('"'), value, F.lit('"'))).when(kind == 5, F.lit("true")).otherwise(value)
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    time = (
        F.when(kind == 6, F.lit('"not-a-date"'))
        .when(kind == 9, F.lit("1704067200"))
        .when(kind == 7, F.concat(F.lit('"'), clock, F.lit('-05:00"')))
        .otherwise(F.concat(F.lit('"'), clock, F.lit('Z"')))
    )
    body = F.concat(
        F.lit('{"pseudo_user_id":'), user,
        F.when(kind == 2, F.lit("")).otherwise(F.concat(F.lit(',"content_id":'), content)),
        F.lit(',"watch_pct":'), pct, F.lit(',"timestamp":'), time, F.lit(',"genre":"drama"}'),
    )
    text = (
        F.when(kind == 0, F.lit("not json {"))
        .when(kind == 1, F.lit("[1,2]"))
        .when(kind == 10, F.lit("42"))
        .otherwise(body)
    )
    return read_events(spark, sf_dir).select("event_id", text.alias("value"))


def computed_at() -> Column:
    """Compute time of a feature row: up to eight seconds after arrival."""
    return F.col("arrival_us") / float(cfg.MICROS) + (F.col("arrival_seq") % 9)


def session_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session starts: one in seven lacks its session id, one in eleven its start time."""
    events = read_events(spark, sf_dir)
    missing_id = F.col("event_id") % 7 == 3
    missing_start = F.col("event_id") % 11 == 5
    return events.select(
        "event_id",
        "user_id",
        F.when(~missing_id, F.concat(F.lit("s"), F.col("event_id").cast("string"))).alias("session_id"),
        _pick(["mobile", "smart-tv", "web"], F.col("event_id") % 3).alias("device"),
        F.when(missing_start, F.lit("not-a-date"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("start_time"),
    )


def consent_changes(spark: SparkSession, sf_dir: str, secret: str | None = None) -> DataFrame:
    """signup grants consent, error revokes it; times reach back up to seven months."""
    events = read_events(spark, sf_dir).filter(F.col("event_type").isin("signup", "error"))
    return events.select(
        pseudonymize(F.col("user_id"), secret or cfg.pseudonym_secret()).alias("user_pseudo_id"),
        (F.col("event_type") == "signup").alias("consent_granted"),
        F.when(F.col("event_type") == "error", F.lit("user request")).alias("reason"),
        F.timestamp_micros(F.col("t_us") - (F.col("event_id") % 8) * F.lit(30 * DAY_US)).alias("ts"),
        F.col("event_id").alias("seq"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served requests: endpoint, latency and outcome. Half of the failed ones have no latency, some no endpoint."""
    n = F.col("event_id")
    return read_events(spark, sf_dir).select(
        F.when(n % 31 != 0, F.col("event_type")).alias("endpoint"),
        F.when((n % 50 != 0) | (n % 100 == 0), F.col("value")).alias("latency_ms"),
        (F.col("event_id") % 50 != 0).alias("ok"),
        F.timestamp_micros("t_us").alias("ts"),
    )


def recommendation_requests(spark: SparkSession, sf_dir: str, secret: str | None = None) -> DataFrame:
    """view rows as recommendation requests made twelve hours after the event time."""
    events = read_events(spark, sf_dir).filter(F.col("event_type") == "view")
    return events.select(
        F.col("event_id").alias("request_id"),
        pseudonymize(F.col("user_id"), secret or cfg.pseudonym_secret()).alias("pseudo_user_id"),
        (F.col("t_us") + F.lit(12 * HOUR_US)).alias("request_us"),
    )


def users(spark: SparkSession, sf_dir: str, secret: str | None = None) -> DataFrame:
    """Distinct users of the table, hashed once each."""
    ids = read_events(spark, sf_dir).select("user_id").distinct()
    return ids.select(pseudonymize(F.col("user_id"), secret or cfg.pseudonym_secret()).alias("pseudo_user_id"))


def model_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchase rows as alias assignments of registered model versions."""
    events = read_events(spark, sf_dir).filter(F.col("event_type") == "purchase")
    name = F.concat(F.lit("model-"), (F.col("user_id").cast("bigint") % 40).cast("string"))
    alias = F.when(F.col("event_id") % 3 == 0, F.lit("production")).otherwise(F.lit("staging"))
    return events.select(
        name.alias("name"),
        F.col("event_id").alias("version"),
        alias.alias("alias"),
        F.col("t_us").alias("assigned_at"),
        ((F.col("event_id") % 101) / 100.0).alias("auc"),
        ((F.col("event_id") % 11) / 10.0).alias("precision_at_10"),
    )
