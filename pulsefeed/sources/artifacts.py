"""Model versions on shared storage: the fitted pipeline and its contract together."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.operators.registry import current_aliases, resolve
from pulsefeed.schemas import REGISTRY
from pulsefeed.sources import files


class ModelRegistry:
    """Append-only registry table next to the version directories it points to."""

    def __init__(self, spark: SparkSession, root: str, name: str = cfg.MODEL_NAME):
        self.spark = spark
        self.root = root.rstrip("/")
        self.name = name

    def table(self) -> DataFrame:
        try:
            # Each row lies in a directory of its own: two writers of one directory would clear each other's work.
            reader = self.spark.read.schema(REGISTRY).option("recursiveFileLookup", "true")
            return reader.parquet(f"{self.root}/registry")
        except AnalysisException:
            return self.spark.createDataFrame([], REGISTRY)

    def assignments(self) -> DataFrame:
        return self.table().filter(F.col("name") == self.name)

    def next_version(self) -> int:
        return (self.assignments().agg(F.max("version")).first()[0] or 0) + 1

    def _claim(self, run: str) -> int:
        claims = f"{self.root}/claims/{self.name}"
        taken = [int(n) for n in files.names(self.spark, claims, False) if n.isdigit()]
        version = max([self.next_version(), *(n + 1 for n in taken)])
        while not files.create_new(self.spark, f"{claims}/{version}", run):
            version += 1
        return version

    def _append(self, **row) -> None:
        record = {f: row.get(f) for f in REGISTRY.fieldNames()}
        frame = self.spark.createDataFrame([tuple(record.values())], REGISTRY)
        frame.coalesce(1).write.parquet(f"{self.root}/registry/{uuid.uuid4().hex}")

    def register(
        self, model: PipelineModel, contract: dict, alias: str, model_type: str,
        params: dict[str, str], metrics: dict[str, float],
    ) -> int:
        """Save model and contract, then make the version visible with one registry row.

        The number is claimed by creating its file, which only one of several
        trainings can; the next one takes the next number. Each writes to a
        directory of its own, so none can touch what another has saved.
        """
        run = uuid.uuid4().hex
        version = self._claim(run)
        path = f"{self.root}/models/{self.name}/version={version}/run={run}"
        text = self.spark.createDataFrame([(json.dumps(contract),)], "value string")
        text.coalesce(1).write.text(f"{path}/feature_schema")
        model.save(f"{path}/model")
        self._append(
            name=self.name, version=version, alias=alias, assigned_at=time.time_ns() // 1000, path=path,
            model_type=model_type, params={k: str(v) for k, v in params.items()}, metrics=metrics,
        )
        return version

    def set_alias(self, version: int, alias: str) -> None:
        """Point an alias at an existing version: a new assignment, nothing is rewritten."""
        found = self.assignments().filter(F.col("version") == version).first()
        if found is None:
            raise ValueError(f"model {self.name!r} has no version {version}")
        self._append(**{**found.asDict(), "alias": alias, "assigned_at": time.time_ns() // 1000})

    def promote(self, version: int, minimums: dict[str, float], alias: str = "production") -> bool:
        """Move the alias only if every metric exceeds its minimum."""
        found = self.assignments().filter(F.col("version") == version).first()
        if found is None:
            raise ValueError(f"model {self.name!r} has no version {version}")
        metrics = found["metrics"] or {}
        if not all(metrics.get(m, float("-inf")) > least for m, least in minimums.items()):
            return False
        self.set_alias(version, alias)
        return True

    def aliases(self) -> DataFrame:
        return current_aliases(self.assignments())

    def resolve(self, aliases: list[str] | None = None) -> int | None:
        """Version under the first existing alias (production, then staging)."""
        found = resolve(self.assignments(), aliases).first()
        return None if found is None else found["version"]

    def load(self, version: int) -> tuple[PipelineModel, dict]:
        found = self.assignments().filter(F.col("version") == version).select("path").first()
        if found is None:
            raise ValueError(f"model {self.name!r} has no version {version}")
        path = found["path"]
        contract = json.loads(self.spark.read.text(f"{path}/feature_schema").first()[0])
        return PipelineModel.load(f"{path}/model"), contract
