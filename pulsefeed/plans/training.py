"""Feature log to registered model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.operators import matrix
from pulsefeed.operators.dedup import dedup_feature_rows
from pulsefeed.operators.evaluation import precision_at_k
from pulsefeed.sources.artifacts import ModelRegistry
from pulsefeed.sources.feature_log import read_log

_VALIDATION = "_is_validation"
_BUCKET_INDEX = "_bucket_index"
_FEATURES = "_features"


@dataclass(frozen=True)
class TrainingConfig:
    range_days: int = cfg.TRAINING_RANGE_DAYS
    validation_days: int = cfg.VALIDATION_DAYS
    threshold: float = cfg.ENGAGED_THRESHOLD
    model_type: str = "gbt"
    params: dict = field(default_factory=dict)
    alias: str = "staging"
    dedup: bool = True
    # The label is computed from avg_watch_duration; dropping it asks a harder question.
    drop_label_source: bool = False


def _gbt(params: dict) -> Estimator:
    """Boosted trees; rounds stop early on the validation rows."""
    defaults = {"maxIter": cfg.BOOST_ROUNDS, "stepSize": cfg.LEARNING_RATE, "maxDepth": 5, "validationTol": 0.001}
    return GBTClassifier(
        featuresCol=_FEATURES, labelCol=cfg.LABEL, validationIndicatorCol=_VALIDATION, seed=7, **{**defaults, **params}
    )


def _forest(params: dict) -> Estimator:
    return RandomForestClassifier(featuresCol=_FEATURES, labelCol=cfg.LABEL, seed=7, **{"numTrees": 50, **params})


def _logistic(params: dict) -> Estimator:
    return LogisticRegression(featuresCol=_FEATURES, labelCol=cfg.LABEL, **params)


TRAINERS: dict[str, Callable[[dict], Estimator]] = {
    "gbt": _gbt,
    "random_forest": _forest,
    "logistic": _logistic,
}


def make_trainer(model_type: str, params: dict | None = None) -> Estimator:
    if model_type not in TRAINERS:
        raise ValueError(f"unknown model type {model_type!r}; available: {sorted(TRAINERS)}")
    return TRAINERS[model_type](dict(params or {}))


def build_pipeline(columns: list[str], model_type: str, params: dict | None = None) -> Pipeline:
    """Category index (fixed order, an extra slot for unknown), vector, estimator."""
    index = StringIndexerModel.from_labels(
        cfg.TIME_OF_DAY, inputCol="time_of_day_bucket", outputCol=_BUCKET_INDEX, handleInvalid="keep"
    )
    stages = [index]
    bucket = _BUCKET_INDEX
    if model_type == "logistic":
        bucket = "_bucket_onehot"
        stages.append(OneHotEncoder(inputCols=[_BUCKET_INDEX], outputCols=[bucket], handleInvalid="keep"))
    genres = [c for c in columns if c.startswith(matrix.GENRE_PREFIX)]
    if matrix.is_wide(genres):
        columns = [*[c for c in columns if c not in set(genres)], matrix.GENRE_VECTOR]
    inputs = [bucket if c == "time_of_day_bucket" else c for c in columns]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=_FEATURES))
    stages.append(make_trainer(model_type, params))
    return Pipeline(stages=stages)


def positive_probability() -> Column:
    """P(engaged), clipped to [0, 1]."""
    p = vector_to_array("probability")[1]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


def feature_importances(model: PipelineModel, columns: list[str]) -> dict[str, float]:
    """Importance per contract feature; coefficient size for a linear model."""
    fitted = model.stages[-1]
    if hasattr(fitted, "featureImportances"):
        return {c: float(v) for c, v in zip(columns, fitted.featureImportances.toArray())}
    weights = [abs(float(v)) for v in fitted.coefficients.toArray()]
    # The one-hot block spans several slots: fold it into its feature.
    width = len(weights) - (len(columns) - 1)
    at = columns.index("time_of_day_bucket")
    folded = weights[:at] + [max(weights[at:at + width])] + weights[at + width:]
    return dict(zip(columns, folded))


def evaluate(scored: DataFrame, tie_break: list[str]) -> dict[str, float]:
    """Exact AUC (no binning) and precision at k of rows with ``score`` and the label."""
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol=cfg.LABEL, numBins=0).evaluate(scored)
    p = precision_at_k(scored, tie_break).first()["precision_at_k"]
    return {"auc": float(auc), f"precision_at_{cfg.PRECISION_K}": float(p)}


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    contract: dict
    metrics: dict[str, float]
    params: dict[str, object]


def train(rows: DataFrame, config: TrainingConfig = TrainingConfig()) -> Trained:
    """Split, build the matrix, fit and evaluate. ``rows`` are feature rows."""
    cutoff = matrix.find_cutoff(rows, config.validation_days)
    genres = matrix.known_genres(rows.filter(F.col("event_date") < cutoff))
    columns = matrix.matrix_columns(genres, config.drop_label_source)
    contract = matrix.schema_contract(genres, config.threshold, columns)
    matrix.require_contract(rows.schema, contract)
    key = ["pseudo_user_id", "last_event_epoch"]
    keep = [*key, "event_date"]
    if matrix.is_wide(genres):
        data = matrix.sparse_matrix(rows, genres, config.threshold, keep)
        data = data.withColumn(matrix.GENRE_VECTOR, matrix.sparse_vector(F.col("genre_weights"))).drop("genre_weights")
    else:
        data = matrix.feature_matrix(rows, genres, config.threshold, keep)
    data = data.withColumn(_VALIDATION, F.col("event_date") >= cutoff)
    # Read once for many boosting rounds; lost blocks are rebuilt from the log.
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = data.groupBy(_VALIDATION).agg(F.count("*").alias("n"), F.avg(cfg.LABEL).alias("rate")).collect()
        by_split = {r[_VALIDATION]: r for r in stats}
        pipeline = build_pipeline(columns, config.model_type, config.params)
        uses_validation = config.model_type == "gbt"
        model = pipeline.fit(data if uses_validation else data.filter(~F.col(_VALIDATION)))
        validation = data.filter(F.col(_VALIDATION))
        scored = model.transform(validation).select(*key, cfg.LABEL, positive_probability().alias("score"))
        metrics = evaluate(scored, key)
    finally:
        data.unpersist()
    metrics |= {f"importance_{c}": v for c, v in feature_importances(model, columns).items()}
    logged = {
        "model": config.model_type, "range_days": config.range_days, "validation_days": config.validation_days,
        "threshold": config.threshold, "train_rows": by_split[False]["n"], "validation_rows": by_split[True]["n"],
        "positive_rate": by_split[False]["rate"],
    }
    params = {cfg.LOGGED_PARAMETERS[k]: v for k, v in logged.items()}
    params |= {f"{cfg.LOGGED_MODEL_PREFIX}{k}": v for k, v in config.params.items()}
    return Trained(model, contract, metrics, params)


def train_and_register(
    spark: SparkSession, log_path: str, registry: ModelRegistry, as_of: dt.date, config: TrainingConfig = TrainingConfig()
) -> int:
    """Read the log's last days, train, and register a new version under the alias."""
    low, high = matrix.training_window(as_of, config.range_days)
    rows = read_log(spark, log_path, low, high)
    if config.dedup:
        rows = dedup_feature_rows(rows)
    result = train(rows, config)
    return registry.register(
        result.model, result.contract, config.alias, config.model_type, result.params, result.metrics
    )
