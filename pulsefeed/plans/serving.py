"""Batch recommendations from the stores and a registered model."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.operators import matrix, recommend
from pulsefeed.plans.training import positive_probability

USER = "pseudo_user_id"
_KEPT = "_kept"


def engagement_scores(features: DataFrame, model: PipelineModel, contract: dict) -> DataFrame:
    """Feature rows plus ``engagement``: the model's probability on the contract's vector."""
    matrix.require_contract(features.schema, contract)
    kept = features.withColumn(_KEPT, F.struct(*features.columns))
    vectors = matrix.serving_vectors(kept, contract, keep=[_KEPT])
    return model.transform(vectors).select(f"{_KEPT}.*", positive_probability().alias("engagement"))


def recommend_users(
    users: DataFrame,
    consent: DataFrame,
    latest: DataFrame,
    as_of: Column,
    catalog: DataFrame,
    trending: DataFrame,
    model: tuple[PipelineModel, dict, int] | None,
    top_n: int = cfg.TOP_N_DEFAULT,
) -> DataFrame:
    """Recommendations or fallback for every user; no model means the fallback for all."""
    recommend.check_top_n(top_n)
    routed = recommend.route(users, consent, latest, as_of, model_ready=model is not None)
    if model is None:
        return recommend.recommendations(routed, catalog, trending, F.lit(0.0), F.lit(None).cast("string"), top_n)
    fitted, contract, number = model
    # Those to be scored and those to be fed are read apart; lost blocks are rebuilt.
    routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
    return recommend.recommendations(
        routed, catalog, trending, F.col("engagement"), F.lit(str(number)), top_n,
        score=lambda personal: engagement_scores(personal, fitted, contract),
    )
