"""Online view maintained from the feature log, in a second, stateless stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from pulsefeed import settings as cfg
from pulsefeed.schemas import ARRIVAL, FEATURE_ROW
from pulsefeed.sources import files
from pulsefeed.sources.batch_log import BATCH
from pulsefeed.sources.feature_log import LOG_SCHEMA, PARTITIONS, batch_log
from pulsefeed.sources.latest_table import LatestTable, stream_run

USER = "pseudo_user_id"
_ONLINE = T.StructType(
    FEATURE_ROW.fields + [T.StructField(c, T.LongType()) for c in ARRIVAL]
    + [T.StructField("expires_at", T.DoubleType())]
)


def online_table(spark: SparkSession, path: str) -> LatestTable:
    return LatestTable(spark, path, _ONLINE, USER, ARRIVAL)


def log_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Feature rows as the file sink logs them; a log that is compacted in place cannot be followed file by file."""
    if files.exists(spark, path) and not files.exists(spark, f"{path}/_spark_metadata"):
        if any(BATCH in part for day in batch_log(spark, path).stored() for part in files.names(spark, f"{path}/{day}", True)):
            raise ValueError(f"{path} is written in compacted batches: keep the online view with the stream that writes it")
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).drop(*PARTITIONS)


def online_writer(
    rows: DataFrame, table: LatestTable, checkpoint: str, ttl_seconds: int = cfg.ONLINE_TTL_SECONDS,
    compact_every: int = 50,
) -> DataStreamWriter:
    """Upsert each batch of feature rows; a repeated batch replaces itself."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        table.upsert(
            batch.withColumn("expires_at", F.col("computed_at_epoch") + F.lit(float(ttl_seconds))), batch_id, stream_run(batch)
        )
        if batch_id and batch_id % compact_every == 0:
            table.compact()

    return rows.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
