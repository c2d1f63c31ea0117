"""A "latest row per key" table fed by micro-batches.

Each batch appends its own latest rows in a directory named after the stream run
and the batch, so repeating a batch after a failure replaces that directory and
changes nothing. A new checkpoint is a new run: its batch numbers start again and
meet no directory of an earlier one. Readers take the newest row per key over the
last compacted base and the batches it does not hold. Writing costs what the
batch costs, not what the table holds; ``compact`` folds the batches into a new
base now and then, and records up to which batch of each run it did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsefeed.sources import files

FIRST_RUN = "0"


def stream_run(batch: DataFrame) -> str:
    """The id of the streaming query that a micro-batch is of: kept by its checkpoint, new with a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or FIRST_RUN


class LatestTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, order: list[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        self.key = key
        self.order = order

    def latest(self, rows: DataFrame) -> DataFrame:
        """Newest row per key, combined map-side; the row itself breaks exact ties."""
        rest = [c for c in self.schema.fieldNames() if c != self.key]
        body = F.struct(*self.order, *[c for c in rest if c not in self.order])
        picked = rows.groupBy(self.key).agg(F.max(body).alias("_row"))
        return picked.select(self.key, "_row.*").select(*self.schema.fieldNames())

    def upsert(self, batch: DataFrame, batch_id: int, run: str = FIRST_RUN) -> None:
        self.latest(batch).write.mode("overwrite").parquet(f"{self.path}/delta/batch={run}.{batch_id}")

    def read(self) -> DataFrame:
        base, merged = self._base()
        return self._over(base, self._pending(merged))

    def compact(self) -> int | None:
        """Fold all finished batches into a new base; returns its number.

        Readers switch once the record of merged batches, written last, is
        complete. The directories a base replaces are removed by the next
        compaction, so plans made before the switch still find their files.
        """
        base, merged = self._base()
        pending = self._pending(merged)
        if not pending:
            return base
        new = 0 if base is None else base + 1
        self._over(base, pending).write.mode("overwrite").parquet(f"{self.path}/base/number={new}")
        upto = dict(merged)
        for run, batch_id in pending:
            upto[run] = max(batch_id, upto.get(run, -1))
        record = self.spark.createDataFrame(sorted(upto.items()), "run string, batch_id long")
        record.coalesce(1).write.mode("overwrite").json(f"{self.path}/merged/number={new}")
        for run, batch_id in self._batches():
            if batch_id <= merged.get(run, -1):
                files.delete(self.spark, f"{self.path}/delta/batch={run}.{batch_id}")
        if base is not None:
            for folder in ("base", "merged"):
                for n in self._numbers(folder):
                    if n < base:
                        files.delete(self.spark, f"{self.path}/{folder}/number={n}")
        return new

    # --- files -----------------------------------------------------------------

    def _over(self, base: int | None, batches: list[tuple[str, int]]) -> DataFrame:
        paths = [f"{self.path}/delta/batch={run}.{batch_id}" for run, batch_id in batches]
        if base is not None:
            paths.append(f"{self.path}/base/number={base}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.latest(self.spark.read.schema(self.schema).parquet(*paths))

    def _complete(self, folder: str, name: str) -> list[str]:
        found = files.partition_values(self.spark, f"{self.path}/{folder}", name)
        return [v for v in found if files.exists(self.spark, f"{self.path}/{folder}/{name}={v}/_SUCCESS")]

    def _numbers(self, folder: str) -> list[int]:
        return sorted(int(v) for v in self._complete(folder, "number"))

    def _batches(self) -> list[tuple[str, int]]:
        named = (v.rsplit(".", 1) for v in self._complete("delta", "batch"))
        return sorted((run, int(batch_id)) for run, batch_id in named)

    def _base(self) -> tuple[int | None, dict[str, int]]:
        """The newest base with its record, and the last merged batch of each run: one row per run."""
        numbers = self._numbers("merged")
        if not numbers:
            return None, {}
        record = self.spark.read.schema("run string, batch_id long").json(f"{self.path}/merged/number={numbers[-1]}")
        return numbers[-1], {r.run: r.batch_id for r in record.collect()}

    def _pending(self, merged: dict[str, int]) -> list[tuple[str, int]]:
        return [(run, i) for run, i in self._batches() if i > merged.get(run, -1)]
