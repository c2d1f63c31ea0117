"""Declared schemas of every record the platform reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


S, D, I, L, B, TS = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType(),
)

# Raw input. Every field is read as text: the boundary check does the typing.
WATCH_INPUT = _schema(
    ("user_id", S, True), ("content_id", S, True), ("watch_pct", S, True),
    ("timestamp", S, True), ("genre", S, True), ("timezone", S, True),
)
SESSION_INPUT = _schema(
    ("user_id", S, True), ("session_id", S, True), ("device", S, True), ("start_time", S, True),
)

# One JSON message of the watch topic.
WATCH_MESSAGE = _schema(
    ("pseudo_user_id", S, True), ("content_id", S, True), ("watch_pct", D, True),
    ("timestamp", S, True), ("genre", S, True), ("timezone", S, True),
)
MESSAGE_REQUIRED = ["pseudo_user_id", "content_id", "watch_pct", "timestamp"]

# Parsed watch event, the input of the feature operators. Times are integer
# microseconds so that window edges compare exactly.
WATCH_EVENT = _schema(
    ("pseudo_user_id", S, False), ("content_id", S, True), ("watch_pct", D, False),
    ("genre", S, True), ("timezone", S, True), ("event_us", L, False),
    ("event_date", S, False), ("arrival_us", L, False), ("arrival_seq", L, False),
)

FEATURE_ROW = _schema(
    ("pseudo_user_id", S, False),
    ("watch_count_10min", I, False),
    ("category_affinity_score", D, False),
    ("avg_watch_duration", D, False),
    ("time_of_day_bucket", S, False),
    ("recency_score", D, False),
    ("session_genre_vector", S, False),
    ("last_event_epoch", D, False),
    ("computed_at_epoch", D, False),
    ("event_date", S, False),
)
FEATURE_COLUMNS = FEATURE_ROW.fieldNames()
# Arrival position travels with a feature row until it is stored.
ARRIVAL = ["arrival_us", "arrival_seq"]

# Keyed state of the streaming feature operator: the events of a user's last
# window as columns of numbers (times as int64, percentages as float64, genres as
# int32 positions in ``genres``, -1 for none). It is stored in Avro, so fields may
# be added at the end and a restart reads older state with them null; none may
# change its type or be removed.
USER_STATE = _schema(
    ("hwm_us", L, True), ("event_us", T.BinaryType(), True), ("watch_pct", T.BinaryType(), True),
    ("genre_at", T.BinaryType(), True), ("genres", T.ArrayType(S), True),
)

CONSENT = _schema(("user_pseudo_id", S, False), ("consent_granted", B, False), ("updated_at", TS, False))
AUDIT_LOG = _schema(
    ("id", L, False), ("user_pseudo_id", S, False), ("action", S, False),
    ("timestamp", TS, False), ("reason", S, True),
)

# A time-out has no latency, a request that failed early may lack the rest.
REQUEST_LOG = _schema(("endpoint", S, True), ("latency_ms", D, True), ("ok", B, True), ("ts", TS, False))

REGISTRY = _schema(
    ("name", S, False), ("version", L, False), ("alias", S, False), ("assigned_at", L, False),
    ("path", S, True), ("model_type", S, True), ("params", T.MapType(S, S), True), ("metrics", T.MapType(S, D), True),
)
