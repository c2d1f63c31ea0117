"""Online view: the last written feature row per user, with expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.functions.times import HOUR_US, floor_div
from pulsefeed.functions.values import safe_double, safe_int
from pulsefeed.operators.scan import sliced_running
from pulsefeed.operators.window_features import named_users, unnamed_users
from pulsefeed.schemas import ARRIVAL, FEATURE_COLUMNS

USER = "pseudo_user_id"
# An hour is cut into spans of a millisecond at least, an instant into so many runs of each side.
_MOST_SPANS = 3_600_000
_RUNS = 64
_TEXT_FIELDS = {"pseudo_user_id", "time_of_day_bucket", "session_genre_vector", "event_date"}
_INT_FIELDS = {"watch_count_10min"}


def latest_rows(rows: DataFrame, ttl_seconds: int = cfg.ONLINE_TTL_SECONDS) -> DataFrame:
    """Last write per user in arrival order, late events included.

    ``max_by`` combines map-side, so a hot user sends one row per input task.
    """
    body = F.struct(*[c for c in rows.columns if c != USER])
    return (
        rows.groupBy(USER)
        .agg(F.max_by(body, F.struct(*ARRIVAL)).alias("row"))
        .select(USER, "row.*")
        .withColumn("expires_at", F.col("computed_at_epoch") + F.lit(float(ttl_seconds)))
    )


def merge_latest(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert a batch of already-latest rows; merging the same batch twice changes nothing."""
    both = snapshot.unionByName(batch)
    body = F.struct(*[c for c in both.columns if c != USER])
    return both.groupBy(USER).agg(F.max_by(body, F.struct(*ARRIVAL)).alias("row")).select(USER, "row.*")


def encode_hash(latest: DataFrame) -> DataFrame:
    """The stored form: every feature as text."""
    fields = F.map_from_arrays(
        F.array(*[F.lit(c) for c in FEATURE_COLUMNS]),
        F.array(*[F.col(c).cast("string") for c in FEATURE_COLUMNS]),
    )
    return latest.select(
        F.concat(F.lit("user:"), F.col(USER), F.lit(":features")).alias("key"),
        F.col(USER),
        fields.alias("fields"),
        "expires_at",
    )


def decode_hash(stored: DataFrame, fields: str = "fields") -> DataFrame:
    """Typed columns from the stored text; malformed numbers become zero."""

    def typed(name: str) -> Column:
        text = F.try_element_at(F.col(fields), F.lit(name))
        if name in _TEXT_FIELDS:
            return text
        present = text.isNotNull()
        return F.when(present, safe_int(text) if name in _INT_FIELDS else safe_double(text))

    return stored.select(
        *[c for c in stored.columns if c not in (fields, USER)],
        *[typed(c).alias(c) for c in FEATURE_COLUMNS],
    )


def live(latest: DataFrame, as_of: Column) -> DataFrame:
    return latest.filter(F.col("expires_at") > as_of)


def lookup(requests: DataFrame, latest: DataFrame, as_of: Column) -> DataFrame:
    """Requests with the live features of their user; has_features is false on a miss."""
    hits = live(latest, as_of).withColumn("has_features", F.lit(True))
    return requests.join(hits, USER, "left").withColumn(
        "has_features", F.coalesce("has_features", F.lit(False))
    )


def cold_start(users: DataFrame, latest: DataFrame, as_of: Column) -> DataFrame:
    return users.join(live(latest, as_of).select(USER), USER, "left_anti")


def features_as_of(
    requests: DataFrame,
    rows: DataFrame,
    ttl_seconds: int = cfg.ONLINE_TTL_SECONDS,
    hot: list[str] | None = None,
    busy_rows: int = cfg.BUSY_SLICE_ROWS,
) -> DataFrame:
    """Each request with the feature row a lookup at its time would have returned.

    Rows and requests are merged on one time axis per user and the last row
    written is carried forward (a running maximum of its position): no range
    join. Users in ``hot`` are carried over slices of one hour, so that no task
    sorts their whole history; None treats every user that way. An hour of more
    than ``busy_rows`` rows, of either side, is cut into as many spans as bring it
    under, and each instant in it into runs: all of a user's rows may lie in one.

    ``rows`` need written_us besides the feature columns and arrival position;
    ``requests`` need request_id and request_us.
    """
    payload = F.struct("written_us", *ARRIVAL, F.struct(*[c for c in FEATURE_COLUMNS if c != USER]).alias("row"))
    writes = rows.select(
        USER, F.col("written_us").alias("at_us"), F.lit(0).alias("side"),
        F.lit(None).cast("bigint").alias("request_id"), payload.alias("write"),
    )
    asks = requests.select(
        USER, F.col("request_us").alias("at_us"), F.lit(1).alias("side"), "request_id",
        F.lit(None).cast(writes.schema["write"].dataType).alias("write"),
    )
    axis = writes.unionByName(asks)
    axis = named_users(axis)
    columns = [*axis.columns, "last"]

    def plain(part: DataFrame) -> DataFrame:
        so_far = Window.partitionBy(USER).orderBy("at_us", "side").rowsBetween(Window.unboundedPreceding, 0)
        return part.withColumn("last", F.max("write").over(so_far)).select(*columns)

    def sliced(part: DataFrame) -> DataFrame:
        hourly = part.withColumn("hour", floor_div(F.col("at_us"), HOUR_US))
        busy = hourly.groupBy(USER, "hour").agg(F.count("*").alias("_n")).filter(F.col("_n") > busy_rows)
        busy = busy.select(USER, "hour", F.ceil(F.col("_n") / busy_rows).alias("_spans"))
        cut = hourly.join(busy, [USER, "hour"], "left")
        spans = F.coalesce("_spans", F.lit(1))
        in_hour = F.pmod(F.col("at_us"), F.lit(HOUR_US))
        span = floor_div(in_hour * F.least(spans, F.lit(_MOST_SPANS)), HOUR_US)
        # Writes of an instant come before its requests; within either, order does not matter to the last write.
        run = F.col("side") * _RUNS + F.pmod(F.xxhash64("request_id", "write.arrival_us", "write.arrival_seq"), F.lit(_RUNS))
        fine = F.col("_spans").isNotNull()
        cut = cut.withColumns(
            {"span": span, "instant": F.when(fine, F.col("at_us")).otherwise(F.lit(0)), "run": F.when(fine, run).otherwise(F.lit(0))}
        )
        slices = ["hour", "span", "instant", "run"]
        return sliced_running(cut, [USER], slices, ["at_us", "side"], {"last": ("max", F.col("write"))}).select(*columns)

    if hot is None:
        carried = sliced(axis)
    elif not hot:
        carried = plain(axis)
    else:
        # A null in the list would make the comparison null for every other user.
        listed = F.col(USER).isin([u for u in hot if u is not None])
        carried = plain(axis.filter(~listed)).unionByName(sliced(axis.filter(listed)))
    fresh = F.col("last.row.computed_at_epoch") + F.lit(float(ttl_seconds)) > F.col("at_us") / float(cfg.MICROS)
    return unnamed_users(carried.filter(F.col("side") == 1)).select(
        "request_id",
        USER,
        F.col("at_us").alias("request_us"),
        F.coalesce(fresh, F.lit(False)).alias("has_features"),
        *[F.when(fresh, F.col(f"last.row.{c}")).alias(c) for c in FEATURE_COLUMNS if c != USER],
    )
