"""Exact ranking metrics and percentiles without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.operators.scan import sliced_running

_EPS = 1e-12


def _score_slice(score: Column) -> Column:
    """Monotone slice of a probability, fine near 0 and 1 where scores crowd."""
    p = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    return F.floor(F.lit(32.0) * F.log((p + F.lit(_EPS)) / (F.lit(1.0 + _EPS) - p))).cast("bigint")


def auc(scored: DataFrame, score: str = "score", label: str = cfg.LABEL) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows are first reduced to counts per distinct score (map-side). Negatives
    below each score come from a two-level running sum over score slices.
    """
    per_score = scored.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("neg"),
    )
    sliced = per_score.withColumn("all", F.lit(0)).withColumn("bin", _score_slice(F.col("s")))
    # Both sums are carried so that both readers of the counts share one shuffle.
    below = sliced_running(
        sliced, ["all"], ["bin"], ["s"], {"neg_to": ("sum", F.col("neg")), "pos_to": ("sum", F.col("pos"))}
    )
    wins = F.col("pos").cast("double") * (F.col("neg_to").cast("double") - F.col("neg").cast("double") / 2.0)
    return below.agg(
        F.sum(wins).alias("w"), F.max("pos_to").alias("n_pos"), F.max("neg_to").alias("n_neg")
    ).select(
        F.when(
            (F.col("n_pos") > 0) & (F.col("n_neg") > 0),
            F.col("w") / (F.col("n_pos").cast("double") * F.col("n_neg").cast("double")),
        ).alias("auc"),
        "n_pos",
        "n_neg",
    )


def precision_at_k(
    scored: DataFrame, tie_break: list[str], k: int = cfg.PRECISION_K,
    score: str = "score", label: str = cfg.LABEL,
) -> DataFrame:
    """Mean label of the k best scores (fewer if there are fewer); ties by row key."""
    best = scored.orderBy(F.desc(score), *tie_break).limit(k)
    return best.agg(F.avg(F.col(label).cast("double")).alias("precision_at_k"), F.count("*").alias("k"))


def _value_slice(value: Column) -> Column:
    """Monotone logarithmic slice: about 1.6 percent wide, for any range of values."""
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * 64.0)).cast("bigint")


_NONE = "\u0001none"


def index_percentiles(
    df: DataFrame, keys: list[str], value: str, percents: list[int], sums: dict[str, Column] | None = None
) -> DataFrame:
    """Per key, ``sorted[min(int(n * p / 100), n - 1)]`` for each percent, and n, the number of values.

    Values are reduced to counts per distinct value, cumulated in two levels,
    and the first value whose cumulative count passes the index is taken.
    ``sums`` are further totals per key taken in the same pass, over all rows:
    also those whose value is null. Null text keys are a group.
    """
    extra = sums or {}
    text = [k for k in keys if df.schema[k].dataType.typeName() == "string"]
    named = df.withColumns({k: F.coalesce(F.col(k), F.lit(_NONE)) for k in text})
    # Rows without a value are one cell before all others. No key or slice is null then, so
    # no filter sets the two readers of the counts apart and they share one scan and shuffle.
    counts = named.groupBy(*keys, F.col(value).alias("v")).agg(
        F.count(value).alias("c"), *[F.coalesce(F.sum(expr), F.lit(0)).alias(name) for name, expr in extra.items()]
    )
    sliced = counts.withColumn("bin", F.coalesce(_value_slice(F.col("v")), F.lit(-(1 << 62))))
    cumulative = sliced_running(
        sliced.withColumnsRenamed({name: f"_s_{name}" for name in extra}),
        keys,
        ["bin"],
        ["v"],
        {"upto": ("sum", F.col("c"))} | {f"_r_{name}": ("sum", F.col(f"_s_{name}")) for name in extra},
        grand={"n": "upto"},
    )

    def pick(p: int) -> Column:
        index = F.least(F.floor(F.col("n") * F.lit(p) / F.lit(100.0)).cast("bigint"), F.col("n") - 1)
        return F.min(F.when(F.col("upto") > index, F.col("v"))).alias(f"p{p}")

    out = cumulative.groupBy(*keys).agg(
        F.first("n").alias("n"),
        # The total is the last running sum: both readers of the counts then need every column of them.
        *[F.max_by(f"_r_{name}", F.struct("bin", "v")).alias(name) for name in extra],
        *[pick(p) for p in percents],
    )
    return out.withColumns({k: F.nullif(F.col(k), F.lit(_NONE)) for k in text})


def score_histogram(scored: DataFrame, score: str = "score", bins: int = 10, by: list[str] | None = None) -> DataFrame:
    """Counts in equal-width bins of [0, 1]; 1.0 falls into the last bin."""
    b = F.least(F.floor(F.col(score) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    return scored.groupBy(*(by or []), b.alias("bin")).agg(F.count("*").alias("n"))


def stability_index(histogram: DataFrame, by: str, base: str, other: str, features: list[str] | None = None) -> DataFrame:
    """Population stability index between two groups of binned counts.

    Shares are floored at 1e-6 so that an empty bin stays finite.
    """
    keys = features or []
    per_bin = histogram.groupBy(*keys, "bin").agg(
        F.sum(F.when(F.col(by) == base, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col(by) == other, F.col("n")).otherwise(0)).alias("b"),
    )
    # Only one row per (feature, bin) reaches this window.
    everything = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    share = lambda c: F.greatest(F.col(c) / F.sum(c).over(everything), F.lit(1e-6))
    shares = per_bin.select(*keys, share("a").alias("pa"), share("b").alias("pb"))
    return shares.groupBy(*keys).agg(
        F.sum((F.col("pb") - F.col("pa")) * F.log(F.col("pb") / F.col("pa"))).alias("psi")
    )
