"""Training set: split, genre columns, label, feature matrix and its contract."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsefeed import settings as cfg
from pulsefeed.functions.values import genre_map, genre_weight
from pulsefeed.schemas import FEATURE_ROW

GENRE_PREFIX = "genre_"
VECTOR = "session_genre_vector"
GENRE_VECTOR = "genre_vector"
LABEL_SOURCE = "avg_watch_duration"


# --- split --------------------------------------------------------------------------


def split_cutoff(rows: DataFrame, validation_days: int = cfg.VALIDATION_DAYS) -> DataFrame:
    """The N-th last observed date and the number of dates, in one row.

    The set of dates is combined map-side and is no larger than a calendar.
    Fewer than N dates give a NULL cutoff.
    """
    dates = rows.agg(F.sort_array(F.collect_set("event_date"), asc=False).alias("dates"))
    return dates.select(
        F.try_element_at("dates", F.lit(validation_days)).alias("cutoff"),
        F.size("dates").cast("bigint").alias("n_dates"),
    )


def find_cutoff(rows: DataFrame, validation_days: int = cfg.VALIDATION_DAYS) -> str:
    found = split_cutoff(rows, validation_days).first()
    if found["n_dates"] <= validation_days:
        raise ValueError(
            f"{found['n_dates']} distinct dates are not enough for a "
            f"{validation_days}-day validation split"
        )
    return found["cutoff"]


def chronological_split(
    rows: DataFrame, validation_days: int = cfg.VALIDATION_DAYS
) -> tuple[DataFrame, DataFrame]:
    """(train, validation): dates before the cutoff, and from the cutoff on."""
    cutoff = find_cutoff(rows, validation_days)
    return rows.filter(F.col("event_date") < cutoff), rows.filter(F.col("event_date") >= cutoff)


def split_column(cutoff: Column) -> Column:
    return F.when(F.col("event_date") < cutoff, F.lit("train")).otherwise(F.lit("validation"))


def split_stats(
    rows: DataFrame, cutoff: str, threshold: float = cfg.ENGAGED_THRESHOLD, mean: str = LABEL_SOURCE
) -> DataFrame:
    return (
        rows.select(split_column(F.lit(cutoff)).alias("split"), "event_date", label(threshold, mean).alias("y"))
        .groupBy("split")
        .agg(
            F.count("*").alias("n_rows"),
            F.avg("y").alias("positive_rate"),
            F.min("event_date").alias("first_date"),
            F.max("event_date").alias("last_date"),
        )
    )


# --- columns ------------------------------------------------------------------------


def genre_keys(rows: DataFrame) -> DataFrame:
    """Distinct genre names; a zero weight counts, malformed vectors do not."""
    return rows.select(F.explode(F.json_object_keys(VECTOR)).alias("genre")).distinct()


def vocabulary(rows: DataFrame, limit: int = cfg.MAX_VOCABULARY) -> DataFrame:
    """(genre, n_rows) of the ``limit`` genres that most rows hold; ties in name order.

    Genres are text that clients send: there may be any number of them, so they
    are counted before they are exchanged, and the list has a bound.
    """
    counts = rows.select(F.explode(F.json_object_keys(VECTOR)).alias("genre")).groupBy("genre").agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), "genre").limit(limit)


def known_genres(train: DataFrame, limit: int = cfg.MAX_VOCABULARY) -> list[str]:
    """Sorted genre names of the training split (the only split that may define them), of at most ``limit``."""
    return sorted(r["genre"] for r in vocabulary(train, limit).collect())


def label(threshold: float = cfg.ENGAGED_THRESHOLD, mean: str = LABEL_SOURCE) -> Column:
    """Whether the mean, as it was computed and not as it is shown, reaches the threshold."""
    return (F.col(mean) >= F.lit(threshold)).cast("int")


def time_bucket_index() -> Column:
    """Position in the fixed category order; NULL for anything else."""
    out = None
    for i, name in enumerate(cfg.TIME_OF_DAY):
        hit = F.col("time_of_day_bucket") == name
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return out


def genre_columns(genres: list[str], vector: Column | None = None) -> list[Column]:
    weights = genre_map(F.col(VECTOR)) if vector is None else vector
    return [genre_weight(weights, g).alias(GENRE_PREFIX + g) for g in genres]


def matrix_columns(genres: list[str], drop_label_source: bool = False) -> list[str]:
    base = [c for c in cfg.BASE_FEATURES if not (drop_label_source and c == "avg_watch_duration")]
    return base + ["time_of_day_bucket"] + [GENRE_PREFIX + g for g in genres]


def feature_matrix(
    rows: DataFrame,
    genres: list[str],
    threshold: float = cfg.ENGAGED_THRESHOLD,
    keep: list[str] | None = None,
    mean: str = LABEL_SOURCE,
) -> DataFrame:
    """Base columns, category index, one column per known genre, and the label.

    The vector is parsed once per row; genres outside the list are ignored.
    """
    parsed = rows.withColumn("_genres", genre_map(F.col(VECTOR)))
    return parsed.select(
        *(keep or []),
        *cfg.BASE_FEATURES,
        "time_of_day_bucket",
        time_bucket_index().alias("time_of_day_index"),
        *genre_columns(genres, F.col("_genres")),
        label(threshold, mean).alias(cfg.LABEL),
    )


def sparse_weights(genres: list[str], vector: str = VECTOR) -> Column:
    """The genre weights of a row as (size, indices, values) over the sorted vocabulary; genres outside it are ignored.

    One column whatever the size of the vocabulary, and of a length that only the
    row's own genres decide. The places are one literal map, looked up per genre of the row.
    """
    places = F.from_json(F.lit(json.dumps({g: i for i, g in enumerate(genres)})), "map<string,int>")
    entries = F.transform(
        F.map_entries(genre_map(F.col(vector))),
        lambda e: F.struct(F.try_element_at(places, e["key"]).alias("at"), e["value"].alias("weight")),
    )
    known = F.array_sort(F.filter(entries, lambda e: e["at"].isNotNull() & e["weight"].isNotNull()))
    return F.struct(F.lit(len(genres)).alias("size"), known["at"].alias("indices"), known["weight"].alias("values"))


def sparse_matrix(
    rows: DataFrame, genres: list[str], threshold: float = cfg.ENGAGED_THRESHOLD, keep: list[str] | None = None,
    mean: str = LABEL_SOURCE,
) -> DataFrame:
    """As ``feature_matrix``, with all genre weights in the one sparse column ``genre_weights``."""
    return rows.select(
        *(keep or []), *cfg.BASE_FEATURES, "time_of_day_bucket", time_bucket_index().alias("time_of_day_index"),
        sparse_weights(genres).alias("genre_weights"), label(threshold, mean).alias(cfg.LABEL),
    )


def sparse_vector(weights: Column) -> Column:
    """The sparse column as MLlib's vector. MLlib has no built-in way to make one, so this is a Python step per row."""
    make = F.udf(lambda w: SparseVector(w["size"], w["indices"], w["values"]), VectorUDT(), useArrow=False)
    return make(weights)


def is_wide(genres: list[str]) -> bool:
    """Whether a model's genres are one sparse vector instead of a column each."""
    return len(genres) > cfg.MAX_GENRE_FEATURES


# --- contract -----------------------------------------------------------------------


@dataclass(frozen=True)
class _Kind:
    """A kind of feature: its name in the contract, its type here, and what stands for a missing value."""

    dtype: str
    type: T.DataType
    default: int | float | None  # None: the first category


# The names that the contract file uses.
_KINDS = (_Kind("int32", T.IntegerType(), 0), _Kind("float64", T.DoubleType(), 0.0), _Kind("categorical", T.StringType(), None))
_OF_TYPE = {k.type: k for k in _KINDS}
_OF_NAME = {k.dtype: k for k in _KINDS}
_ROW_TYPES = {f.name: f.dataType for f in FEATURE_ROW.fields}


def schema_contract(genres: list[str], threshold: float = cfg.ENGAGED_THRESHOLD, columns: list[str] | None = None) -> dict:
    """Names, order and types of the features a model was trained on, from the types of the feature row."""
    features = []
    for name in columns or matrix_columns(genres):
        kind = _OF_TYPE[_ROW_TYPES.get(name, T.DoubleType())]
        choice = {"categories": list(cfg.TIME_OF_DAY)} if kind.default is None else {}
        features.append({"name": name, "dtype": kind.dtype, **choice})
    # The keys of the contract file.
    return {
        "version": cfg.CONTRACT_VERSION,
        "features": features,
        "label": cfg.LABEL,
        "label_definition": f"avg_watch_duration >= {threshold}",
        "time_of_day_categories": list(cfg.TIME_OF_DAY),
        "genres": list(genres),
    }


def contract_differences(
    schema: T.StructType, contract: dict, derived_genres: bool = True, known: Iterable[str] | None = None
) -> list[tuple[str, str]]:
    """(column, problem) for every feature missing from or mistyped in ``schema``.

    ``derived_genres``: the table stores the genre vector as JSON, so genre
    columns are covered by that one column. With ``known``, columns that are
    neither features nor known are reported as well.
    """
    present = {f.name: f.dataType for f in schema.fields}
    wanted = {
        VECTOR if derived_genres and f["name"].startswith(GENRE_PREFIX) else f["name"]:
        T.StringType() if derived_genres and f["name"].startswith(GENRE_PREFIX) else _OF_NAME[f["dtype"]].type
        for f in contract["features"]
    }
    problems = [(name, "missing") for name in wanted if name not in present]
    problems += [
        (name, f"expected {expected.simpleString()}, found {present[name].simpleString()}")
        for name, expected in wanted.items()
        if name in present and present[name] != expected
    ]
    if known is not None:
        problems += [(name, "not in the contract") for name in present if name not in wanted and name not in set(known)]
    return sorted(problems)


def require_contract(schema: T.StructType, contract: dict, known: Iterable[str] | None = None) -> None:
    problems = contract_differences(schema, contract, known=known)
    if problems:
        raise ValueError("the table does not fit the feature contract: " + "; ".join(f"{c} {p}" for c, p in problems))


def serving_columns(contract: dict) -> list[Column]:
    """Model input in contract order, each feature in its kind's type with its kind's default.

    Many genres are the one column ``genre_vector``.
    """
    features = contract.get("features")
    if not features:
        raise ValueError("the model contract lists no features")
    genres = contract.get("genres", [])
    if is_wide(genres):
        features = [f for f in features if not f["name"].startswith(GENRE_PREFIX)]
        narrow = serving_columns({**contract, "features": features, "genres": []})
        return [*narrow, sparse_vector(sparse_weights(genres)).alias(GENRE_VECTOR)]
    weights = genre_map(F.col(VECTOR))
    shared = contract.get("time_of_day_categories", cfg.TIME_OF_DAY)

    def column(feature: dict) -> Column:
        name, kind = feature["name"], _OF_NAME[feature["dtype"]]
        genre = name.removeprefix(GENRE_PREFIX)
        value = F.col(name) if genre == name else genre_weight(weights, genre)
        missing = feature.get("categories", shared)[0] if kind.default is None else kind.default
        return F.coalesce(value.cast(kind.type), F.lit(missing)).alias(name)

    return [column(f) for f in features]


def serving_vectors(features: DataFrame, contract: dict, keep: list[str] | None = None) -> DataFrame:
    return features.select(*(keep or []), *serving_columns(contract))


def training_window(as_of: dt.date, days: int = cfg.TRAINING_RANGE_DAYS) -> tuple[str, str]:
    """Inclusive date range [as_of - days, as_of]."""
    return (as_of - dt.timedelta(days=days)).isoformat(), as_of.isoformat()
