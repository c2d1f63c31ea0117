"""Topic messages: JSON strings in, keyed JSON strings out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from pulsefeed import settings as cfg
from pulsefeed.schemas import SESSION_INPUT, WATCH_INPUT

_MESSAGE = "value string, arrival_us bigint, arrival_seq bigint"


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = cfg.WATCH_TOPIC, starting: str = "latest",
    max_offsets: int | None = 1_000_000,
) -> DataFrame:
    """Value-only message stream; needs the Kafka connector on the class path.

    Arrival order is (broker append time, offset): set the topic's timestamp
    type to LogAppendTime. Messages are keyed by user, so a user's offsets are in
    one partition. A checkpoint, not the starting offset, decides where a restart
    resumes.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.unix_micros("timestamp").alias("arrival_us"),
        F.col("offset").alias("arrival_seq"),
    )


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same stream from JSON-lines files holding value and arrival position."""
    reader = spark.readStream.schema(_MESSAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def raw_sessions(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unchecked session starts, as ``raw_watch``."""
    return _raw(spark, path, SESSION_INPUT, max_files)


def raw_watch(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unchecked watch events as text, from JSON lines; events without an arrival position get the time of reading."""
    return _raw(spark, path, WATCH_INPUT, max_files)


def _raw(spark: SparkSession, path: str, fields: T.StructType, max_files: int | None) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fields.fieldNames()])
    schema = schema.add("arrival_us", T.LongType()).add("arrival_seq", T.LongType())
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    now = F.unix_micros(F.current_timestamp())
    return reader.json(path).withColumns(
        {"arrival_us": F.coalesce("arrival_us", now), "arrival_seq": F.coalesce("arrival_seq", F.lit(0).cast("bigint"))}
    )


def keyed_messages(payload: DataFrame, key: str = "pseudo_user_id", fields: list[str] | None = None) -> DataFrame:
    """Payload rows as (key, value) messages; the key keeps a user on one partition."""
    columns = fields or payload.columns
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    rest = [c for c in payload.columns if c not in columns]
    return payload.select(F.col(key).cast("string").alias("key"), body.alias("value"), *rest)


def publish_stream(
    payload: DataFrame, checkpoint: str, *, servers: str | None = None, topic: str = cfg.WATCH_TOPIC,
    path: str | None = None, fields: list[str] | None = None,
) -> DataStreamWriter:
    """Writer for a topic, or for a directory of JSON lines when ``path`` is given."""
    writer = keyed_messages(payload, fields=fields).writeStream.option("checkpointLocation", checkpoint)
    if path is not None:
        return writer.format("json").option("path", path)
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)


def publish_batch(payload: DataFrame, path: str, fields: list[str] | None = None) -> None:
    keyed_messages(payload, fields=fields).write.mode("append").json(path)
