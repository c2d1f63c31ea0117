"""An append-only log in partition directories, fed by micro-batches and compacted in place.

A batch appends its rows under ``<partition>/batch=<run>.<id>``, so repeating it
replaces itself, and a new checkpoint (a new run) never meets the batches of an
older one. Without more, that is a directory per partition and batch for ever.
``compact`` folds a partition's batches into one directory and then creates the
next manifest of the partition, which says up to which batch of each run it holds.
Creating the manifest is the switch: before it readers see the batches, after it
the folded directory and the batches since. What a manifest replaced is deleted by
the next compaction, so plans made before the switch still find their files.

Rows may also lie directly in a partition's directory, as a plain partitioned
write leaves them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsefeed.sources import files

BATCH = "batch"
_FOLDED = "folded"
_MANIFESTS = "_manifests"


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partitions: list[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.columns = schema.fieldNames()
        self.partitions = partitions
        text = [T.StructField(c, T.StringType(), True) for c in [*partitions, BATCH]]
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + text)

    def append(self, rows: DataFrame, batch_id: int, run: str) -> None:
        """Write a batch; ``rows`` hold the partition columns as text."""
        named = rows.select(*self.columns, *self.partitions, F.lit(f"{run}.{batch_id}").alias(BATCH))
        writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*self.partitions, BATCH).parquet(self.path)

    def stored(self) -> list[str]:
        """Directories of the partitions below the path, from the listing alone."""
        found = [""]
        for column in self.partitions:
            found = [f"{p}/{column}={v}" for p in found for v in files.partition_values(self.spark, self.path + p, column)]
        return [p.lstrip("/") for p in found]

    def live(self, partition: str) -> list[str]:
        """What readers of a partition read: its folded directory, the batches since, and files of plain writes."""
        number, upto = self._manifest(partition)
        where = f"{self.path}/{partition}"
        out = [f"{where}/{BATCH}={_FOLDED}.{number}"] if number is not None else []
        out += [f"{where}/{BATCH}={run}.{i}" for run, i in self._batches(partition) if i > upto.get(run, -1)]
        if any(not n.startswith(("_", ".")) for n in files.names(self.spark, where, False)):
            out.append(f"{where}/*.parquet")
        return out

    def read(self, partitions: Iterable[str] | None = None, **options: str) -> DataFrame:
        """Rows with their partition columns; ``options`` go to the reader."""
        paths = [p for part in (self.stored() if partitions is None else partitions) for p in self.live(part)]
        shown = [*self.columns, *self.partitions]
        if not paths:
            return self.spark.createDataFrame([], self.schema).select(*shown)
        reader = self.spark.read.schema(self.schema).options(basePath=self.path, **options)
        return reader.parquet(*paths).select(*shown)

    def compact(self, least: int = 2, partitions: Iterable[str] | None = None) -> list[str]:
        """Fold partitions with at least ``least`` batches since their last compaction; returns those folded."""
        done = []
        for part in self.stored() if partitions is None else partitions:
            number, upto = self._manifest(part)
            fresh = [(run, i) for run, i in self._batches(part) if i > upto.get(run, -1)]
            if len(fresh) < least:
                continue
            where = f"{self.path}/{part}"
            # Above every number given out, also to a writer that failed before it was done.
            new = max((n for n in self._numbers(part)), default=-1) + 1
            sources = [f"{where}/{BATCH}={run}.{i}" for run, i in fresh]
            if number is not None:
                sources.append(f"{where}/{BATCH}={_FOLDED}.{number}")
            rows = self.spark.read.schema(self.schema).parquet(*sources).select(*self.columns)
            rows.write.mode("overwrite").parquet(f"{where}/{BATCH}={_FOLDED}.{new}")
            after = dict(upto)
            for run, i in fresh:
                after[run] = max(i, after.get(run, -1))
            if not files.create_new(self.spark, f"{self.path}/{_MANIFESTS}/{part}/{new}", json.dumps(after)):
                continue  # another compaction was first
            done.append(part)
            self._clean(part, number, upto)
        return done

    def drop(self, partition: str) -> None:
        files.delete(self.spark, f"{self.path}/{partition}")
        files.delete(self.spark, f"{self.path}/{_MANIFESTS}/{partition}")

    def _clean(self, part: str, number: int | None, upto: dict[str, int]) -> None:
        """Delete what the manifest before the newest had replaced."""
        where = f"{self.path}/{part}"
        for run, i in self._batches(part):
            if i <= upto.get(run, -1):
                files.delete(self.spark, f"{where}/{BATCH}={run}.{i}")
        for n in self._numbers(part):
            if number is not None and n < number:
                files.delete(self.spark, f"{where}/{BATCH}={_FOLDED}.{n}")
                files.delete(self.spark, f"{self.path}/{_MANIFESTS}/{part}/{n}")

    def _batches(self, part: str) -> list[tuple[str, int]]:
        found = (v.rsplit(".", 1) for v in files.partition_values(self.spark, f"{self.path}/{part}", BATCH))
        return sorted((run, int(i)) for run, i in found if run != _FOLDED)

    def _numbers(self, part: str) -> list[int]:
        found = files.names(self.spark, f"{self.path}/{_MANIFESTS}/{part}", False)
        return sorted(int(n) for n in found if n.isdigit())

    def _manifest(self, part: str) -> tuple[int | None, dict[str, int]]:
        """The newest whole manifest; one that is being written, or that a failed writer left, counts as absent."""
        for n in reversed(self._numbers(part)):
            try:
                return n, json.loads(files.read_text(self.spark, f"{self.path}/{_MANIFESTS}/{part}/{n}"))
            except ValueError:
                continue
        return None, {}
