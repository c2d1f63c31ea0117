"""Mixing sources to target weights.

Tokens are summed per source, a repetition rate is derived for each, and every
document is emitted floor(rate) times plus once more with probability equal to
the fraction, drawn from a seeded hash of its id: reruns and lost tasks give the
same mix. One pass tries a few seeds, and each source takes the one whose draws
come nearest its target; this matters for sources of few documents.

Null and empty texts have size 0 and are emitted like others of their source;
null sources are one source, last in order; null ids are drawn by their text.
Rows that repeat an id share one draw, unless together they hold more than a
thousandth of their source: those are drawn apart, by their place in the input,
so that no draw decides over much of a target. A source without words has rate 1.
An empty table gives an empty mix. Other columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.common import WORD_PATTERN, held, keep, ranked, text_or_empty

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEEDS = 16
# Sources beyond this are joined in salted parts instead of broadcast.
BROADCAST_SOURCES = 100_000
SALTS = 64
# Rows that share an id are drawn apart if they hold more than this share of their source: at most a thousand ids of each.
APART = 0.001


def n_words(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_PATTERN)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS
) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Sources in code point order, null last, take the weights in turn. A target
    stops at ``max_repeats`` times its source; the excess goes to the others by
    weight until none is above. Only totals reach the driver.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    place = (F.col("place") % len(weights)).cast("int")
    weight = F.array(*[F.lit(float(w)) for w in weights])[place]
    sources = keep(ranked(sums, order, "place").select("source", "source_size", weight.alias("weight")), "sources")
    total, weighed = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weighed = total or 0, weighed or 1.0
    cap = F.col("source_size") * F.lit(float(max_repeats))
    level, stopped = share * total / weighed, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        n, spent, free = sources.agg(
            F.count_if(above),
            F.sum(F.when(above, cap).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not n or n == stopped or not free:
            break
        level, stopped = (share * total - spent) / free, n
    target = F.least(F.col("weight") * F.lit(level), cap)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(1.0)
    return sources.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def draw(name: Column, seed: Column) -> Column:
    """A number in [0, 1) fixed by the name and the seed: 52 bits of an MD5."""
    digest = F.md5(F.concat(name, F.lit(":"), seed.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def _copies(rate: Column, name: Column, seed: Column) -> Column:
    whole = F.floor(rate)
    return (whole + (draw(name, seed) < rate - whole).cast("int")).cast("int")


def with_rates(rows: DataFrame, targets: DataFrame, salt: Column, broadcast_limit: int = BROADCAST_SOURCES) -> DataFrame:
    """``rows`` (with ``source``) beside their source's figures.

    Few sources are broadcast, after counting them; otherwise each source's
    figures are repeated for the salts, so a hot source is spread over tasks.
    """
    figures = targets.withColumnRenamed("source", "of_source")
    if targets.count() <= broadcast_limit:
        return rows.join(F.broadcast(figures), F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    spread = figures.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("salt") == F.col("of_salt"))
    return rows.withColumn("salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(spread, on).drop("of_source", "of_salt", "salt")


def draws_apart(sizes: DataFrame, targets: DataFrame, broadcast_limit: int = BROADCAST_SOURCES) -> DataFrame | None:
    """(of_source, of_name) of the repeated names that hold much of their source; None if there is none."""
    repeated = sizes.groupBy("source", "name").agg(F.count("*").alias("n"), F.sum("size").alias("held")).filter("n > 1")
    heavy = with_rates(repeated, targets, F.xxhash64("name"), broadcast_limit).filter(F.col("held") > F.col("source_size") * APART)
    heavy = keep(heavy.select(F.col("source").alias("of_source"), F.col("name").alias("of_name")), "mix-apart")
    return None if heavy.isEmpty() else heavy


def _own_names(rows: DataFrame, apart: DataFrame | None, broadcast_limit: int) -> DataFrame:
    """The rows with names of their own where their draws are apart. Few such names are broadcast, after counting them."""
    if apart is None:
        return rows.drop("tie")
    few = apart.count() <= broadcast_limit
    on = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("name") == F.col("of_name"))
    own = F.when(F.col("of_name").isNotNull(), F.concat_ws("#", "name", "tie")).otherwise(F.col("name"))
    return rows.join(F.broadcast(apart) if few else apart, on, "left").withColumn("name", own).drop("of_source", "of_name", "tie")


def plan_mix(docs: DataFrame, seeds: int = SEEDS, broadcast_limit: int = BROADCAST_SOURCES, **rule) -> DataFrame:
    """(row, size, source_size, target, copies) for every document, also those not taken."""
    name = lambda r: F.coalesce(F.col(f"{r}doc_id").cast("string"), F.md5(text_or_empty(f"{r}text")))
    tie = F.monotonically_increasing_id().alias("tie")
    sizes = keep(docs.select("source", n_words(F.col("text")).alias("size"), name("").alias("name"), tie), "mix-sizes")
    targets = source_targets(sizes, **rule)
    apart = draws_apart(sizes, targets, broadcast_limit)
    sizes = _own_names(sizes, apart, broadcast_limit)
    salt = F.xxhash64("name")
    tried = with_rates(sizes, targets, salt, broadcast_limit).groupBy("source").agg(
        *[F.sum(_copies(F.col("rate"), F.col("name"), F.lit(k)) * F.col("size")).alias(f"seed{k}") for k in range(seeds)],
        F.first("target").alias("target"),
    )
    miss = F.array(*[F.struct(F.abs(F.col(f"seed{k}") - F.col("target")).alias("miss"), F.lit(k).alias("seed")) for k in range(seeds)])
    tried = tried.select(F.col("source").alias("tried"), F.array_min(miss)["seed"].alias("seed"))
    targets = keep(targets.join(tried, F.col("source").eqNullSafe(F.col("tried"))).drop("tried"), "mix-rates")
    rows = held(docs).select("row", F.col("row.source").alias("source"), n_words(F.col("row.text")).alias("size"), name("row.").alias("name"), tie)
    rows = _own_names(rows, apart, broadcast_limit)
    rows = with_rates(rows, targets, salt, broadcast_limit)
    return rows.select("row", "size", "source_size", "target", _copies(F.col("rate"), F.col("name"), F.col("seed")).alias("copies"))


def mix(docs: DataFrame, seeds: int = SEEDS, broadcast_limit: int = BROADCAST_SOURCES, **rule) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns as they were."""
    taken = plan_mix(docs, seeds, broadcast_limit, **rule).filter("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
