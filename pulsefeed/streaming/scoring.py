"""Scoring a stream with the registered model, refreshed between batches."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from pulsefeed.plans.serving import engagement_scores
from pulsefeed.sources.artifacts import ModelRegistry

log = logging.getLogger(__name__)


class CurrentModel:
    """The model in use; replaced only when the resolved version changes."""

    def __init__(self, registry: ModelRegistry, aliases: list[str] | None = None):
        self.registry = registry
        self.aliases = aliases
        self.version: int | None = None
        self._loaded: tuple[PipelineModel, dict] | None = None

    def refresh(self) -> tuple[PipelineModel, dict, int] | None:
        """Latest model, or the one held when the registry or a load fails."""
        try:
            version = self.registry.resolve(self.aliases)
            if version is not None and version != self.version:
                loaded = self.registry.load(version)
                self._loaded, self.version = loaded, version
        except Exception:
            log.exception("model refresh failed; keeping version %s", self.version)
        return None if self._loaded is None else (*self._loaded, self.version)


def scoring_writer(
    rows: DataFrame,
    current: CurrentModel,
    write: Callable[[DataFrame, int, int], None],
    checkpoint: str,
) -> DataStreamWriter:
    """Score each batch with the model current at its start: ``write(scored, version, batch_id)``.

    A batch that finds no model at all fails and is retried by the runner
    rather than being dropped.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        held = current.refresh()
        if held is None:
            raise RuntimeError("no registered model to score with")
        model, contract, version = held
        write(engagement_scores(batch, model, contract), version, batch_id)

    return rows.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
