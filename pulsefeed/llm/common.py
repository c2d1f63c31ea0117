"""What the corpus operators share: the shared folder, ranks, range buckets, word splitting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Runs of anything but ASCII white space, as Java and RE2 patterns read it.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Byte table for the second word notion: A-Z lowered, every ASCII byte but 0-9 and letters a separator.
_PLAIN = bytearray(b" " * 128) + bytearray(range(128, 256))
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _PLAIN[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _PLAIN[_c] = _c + 32
PLAIN_TABLE = bytes(_PLAIN)


def plain_words(text: str | None) -> list[bytes]:
    """Words of ASCII digits, lowered ASCII letters and non-ASCII characters; none for null."""
    return text.encode("utf-8", "replace").translate(PLAIN_TABLE).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share. Where the session names none, a local one is used on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/pulsefeed-{spark.sparkContext.applicationId}"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(docs: DataFrame) -> DataFrame:
    """One struct column ``row``: working columns beside it cannot clash with the caller's."""
    return docs.select(F.struct("*").alias("row"))


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows never learned from; a null id is one of them."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(True))


def longs(values: list[int]) -> Column:
    """An array of longs from one text literal, which Spark folds; thousands of literals would be slow to plan."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def bucket_of(high: Column, low: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the ascending ``bounds`` are <= (high, low), by binary search in literal arrays."""
    n = len(bounds)
    if not n:
        return F.lit(0)
    highs, lows = longs([h for h, _ in bounds]), longs([x for _, x in bounds])

    def step(at: Column, width: Column) -> Column:
        h, x = F.get(highs, at + width - 1), F.get(lows, at + width - 1)
        return F.when((at + width <= n) & ((h < high) | ((h == high) & (x <= low))), at + width).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)]), F.lit(0), step)


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``name``: 0-based position in the total order, without sorting in one task.

    Range partitions are written with their number, since a second run of the
    sampling may cut elsewhere; only one count per partition reaches the driver.
    """
    cut = keep(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = dict(cut.groupBy("_part").count().collect())
    offsets, below = {}, 0
    for part in sorted(counts):
        offsets[part] = below
        below += counts[part]
    start = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])[F.col("_part")] if offsets else F.lit(0)
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return cut.withColumn(name, (start + place - 1).cast("long")).drop("_part")
