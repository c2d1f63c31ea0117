"""Consent-gated scoring, top-N ranking and prioritized fallback."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.functions.values import genre_map

USER = "pseudo_user_id"
# Most items a plan carries inline; beyond it ranking goes through a join.
MAX_INLINE_ITEMS = 2_000


def check_top_n(top_n: int) -> int:
    if not 1 <= top_n <= cfg.TOP_N_MAX:
        raise ValueError(f"top_n must be between 1 and {cfg.TOP_N_MAX}, got {top_n}")
    return top_n


def catalog_frame(spark: SparkSession, items: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Catalog with its list position."""
    listed = pd.DataFrame(cfg.CATALOG if items is None else items, columns=["content_id", "genre", "title"])
    listed.insert(0, "pos", range(len(listed)))
    # Through Arrow: small lists become a local relation of the plan.
    return spark.createDataFrame(listed, "pos int, content_id string, genre string, title string")


def trending_frame(spark: SparkSession, content_ids: list[str] | None = None) -> DataFrame:
    ids = cfg.TRENDING if content_ids is None else content_ids
    listed = pd.DataFrame({"feed_pos": range(len(ids)), "content_id": ids})
    return spark.createDataFrame(listed, "feed_pos int, content_id string")


def resolve_trending(trending: DataFrame, catalog: DataFrame) -> DataFrame:
    """Feed entries with catalog data, in feed order; ids not in the catalog are skipped."""
    return trending.join(catalog.drop("pos"), "content_id").orderBy("feed_pos")


def rankable(catalog: DataFrame, top_n: int) -> DataFrame:
    """The only items that can enter a top-N: the first N of each genre.

    A score depends on the item's genre alone and ties keep catalog order, so
    later items of a genre are always behind N others. What every task then
    holds is at most N x genres, whatever the size of the catalog.
    """
    first = Window.partitionBy("genre").orderBy("pos")
    return catalog.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= top_n).drop("_r")


def _item_array(items: list) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(r["pos"]).alias("pos"), F.lit(r["content_id"]).alias("content_id"),
                F.lit(r["genre"]).alias("genre"), F.lit(r["title"]).alias("title"),
            )
            for r in items
        ]
    )


_ITEMS = "array<struct<pos:int,content_id:string,genre:string,title:string,score:double>>"


def rank_items(
    users: DataFrame,
    catalog: DataFrame,
    engagement: str = "engagement",
    vector: str = "session_genre_vector",
    top_n: int = cfg.TOP_N_DEFAULT,
    inline_limit: int | None = None,
    only: Column | None = None,
) -> DataFrame:
    """Users with ``items``: their best N as an array of (pos, content_id, genre, title, score).

    With ``only``, users for whom it does not hold are not ranked: their items are null.

    score = engagement x share of the item's genre; ties keep catalog order.
    Usually no join and no shuffle: the row is mapped over the small item array.
    A catalog with too many genres for that is joined instead.
    """
    check_top_n(top_n)
    limit = MAX_INLINE_ITEMS if inline_limit is None else inline_limit
    items = rankable(catalog, top_n).orderBy("pos").limit(limit + 1).collect()
    if len(items) > limit:
        if only is None:
            return _ranked_by_join(users, catalog, engagement, vector, top_n)
        # All others share the one pair of nulls.
        masked = users.withColumns({"_oe": F.when(only, F.col(engagement)), "_ov": F.when(only, F.col(vector))})
        ranked = _ranked_by_join(masked, catalog, "_oe", "_ov", top_n).drop("_oe", "_ov")
        return ranked.withColumn("items", F.when(only, F.col("items")))
    return _ranked(users, items, engagement, vector, top_n, only)


def _ranked_by_join(users: DataFrame, catalog: DataFrame, engagement: str, vector: str, top_n: int) -> DataFrame:
    """Ranking through an equi-join on genre.

    A ranking depends on the engagement and the vector alone, so it is made once
    per distinct pair of them and joined back: equal rows, null engagements and
    columns of any type need no key of their own. A pair meets the items of its
    own genres; items of other genres, or of none, score zero, and only the
    first N of the catalog can be among the best then.
    """
    pair = users.select(F.col(engagement).alias("_e"), F.col(vector).alias("_v")).distinct()
    pair = pair.withColumn("_affinity", genre_map(F.col("_v")))
    own = pair.select("_e", "_v", F.explode("_affinity").alias("genre", "_a"))
    scored = own.join(rankable(catalog, top_n), "genre").select(
        "_e", "_v", F.struct((-F.col("_e") * F.col("_a")).alias("neg_score"), "pos", "content_id", "genre", "title").alias("it")
    )
    best = Window.partitionBy("_e", "_v").orderBy("it.neg_score", "it.pos")
    top = (
        scored.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= top_n)
        .groupBy("_e", "_v").agg(F.collect_list("it").alias("own"))
        .select(F.col("_e").alias("_te"), F.col("_v").alias("_tv"), "own")
    )
    head = catalog.orderBy("pos").limit(top_n).collect()
    none = F.array().cast("array<struct<neg_score:double,pos:int,content_id:string,genre:string,title:string>>")
    is_own = lambda it: F.coalesce(F.map_contains_key(F.col("_affinity"), it["genre"]), F.lit(False))
    filler = F.transform(
        F.filter(_item_array(head), lambda it: ~is_own(it)),
        lambda it: F.struct(
            (-F.col("_e") * F.lit(0.0)).alias("neg_score"), it["pos"].alias("pos"), it["content_id"].alias("content_id"),
            it["genre"].alias("genre"), it["title"].alias("title"),
        ),
    )
    same = F.col("_e").eqNullSafe(F.col("_te")) & F.col("_v").eqNullSafe(F.col("_tv"))
    ranked = pair.join(top, same, "left").select(
        F.col("_e").alias("_re"), F.col("_v").alias("_rv"),
        _public_items(F.slice(F.array_sort(F.concat(F.coalesce("own", none), filler)), 1, top_n)).alias("items"),
    )
    back = F.col(engagement).eqNullSafe(F.col("_re")) & F.col(vector).eqNullSafe(F.col("_rv"))
    return users.join(ranked, back, "left").drop("_re", "_rv")


def _public_items(best: Column) -> Column:
    """Ranked entries with a rounded score; adding 0.0 turns negative zero into zero."""
    return F.transform(
        best,
        lambda b: F.struct(
            b["pos"].alias("pos"), b["content_id"].alias("content_id"), b["genre"].alias("genre"),
            b["title"].alias("title"), (F.round(-b["neg_score"], 6) + F.lit(0.0)).alias("score"),
        ),
    ).cast(_ITEMS)


def _ranked(users: DataFrame, items: list, engagement: str, vector: str, top_n: int, only: Column | None = None) -> DataFrame:
    affinity = users.withColumn("_affinity", genre_map(F.col(vector)))
    scored = F.transform(
        _item_array(items),
        lambda it: F.struct(
            (-F.col(engagement) * F.coalesce(F.try_element_at(F.col("_affinity"), it["genre"]), F.lit(0.0)))
            .alias("neg_score"),
            it["pos"].alias("pos"), it["content_id"].alias("content_id"),
            it["genre"].alias("genre"), it["title"].alias("title"),
        ),
    )
    best = F.slice(F.array_sort(scored), 1, top_n)
    best = _public_items(best)
    return affinity.withColumn("items", best if only is None else F.when(only, best)).drop("_affinity")


def explode_items(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.posexplode("items").alias("_i", "item")).select(
        *keep,
        (F.col("_i") + 1).alias("rank"),
        "item.content_id", "item.genre", "item.title", "item.score",
    )


def fallback_reason(granted: Column, has_features: Column, model_ready: Column) -> Column:
    """First gate that closes: consent, features, model; NULL when personalized."""
    return (
        F.when(~granted, "consent_denied")
        .when(~has_features, "cold_start")
        .when(~model_ready, "model_unavailable")
    )


def route(
    users: DataFrame, consent: DataFrame, latest: DataFrame, as_of: Column, model_ready: bool = True
) -> DataFrame:
    """Users with their gates resolved: granted, features, fallback_reason.

    Consent and features are both one row per user, hash-partitioned by user
    like the users themselves: two joins without a further shuffle of either.
    """
    from pulsefeed.operators.consent import consent_gate
    from pulsefeed.operators.online import lookup

    gated = consent_gate(users, consent, USER)
    found = lookup(gated, latest, as_of)
    # Nothing is passed on of a user who has not consented.
    features = [c for c in latest.columns if c != USER]
    found = found.withColumns(
        {c: F.when(F.col("granted"), F.col(c)) for c in features} | {"has_features": F.col("granted") & F.col("has_features")}
    )
    return found.withColumn(
        "fallback_reason", fallback_reason(F.col("granted"), F.col("has_features"), F.lit(model_ready))
    )


def recommendations(
    routed: DataFrame,
    catalog: DataFrame,
    trending: DataFrame,
    engagement: Column,
    model_version: Column,
    top_n: int = cfg.TOP_N_DEFAULT,
    vector: str = "session_genre_vector",
    score: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per (user, rank): personalized, or the trending feed with its reason.

    Only users whom every gate lets through are scored (by ``score``, which adds
    what ``engagement`` reads) and ranked; the others get the constant feed. Without
    ``score`` that is one pass over ``routed``: the gates are columns, and the
    ranking stands under them. A model reads ``routed`` twice, so keep it first.
    """
    check_top_n(top_n)
    feed = [r.asDict() | {"pos": r["feed_pos"]} for r in resolve_trending(trending, catalog).limit(top_n).collect()]
    feed_array = F.transform(
        _item_array(feed) if feed else F.array().cast("array<struct<pos:int,content_id:string,genre:string,title:string>>"),
        lambda it: F.struct(it["pos"], it["content_id"], it["genre"], it["title"], F.lit(None).cast("double")),
    ).cast(_ITEMS)
    keep = [USER, "personalized", "fallback_reason", "model_version"]
    passes = F.col("fallback_reason").isNull()
    outcome = {"personalized": passes, "model_version": F.when(passes, model_version.cast("string"))}
    if score is None:
        ranked = rank_items(routed.withColumn("_engagement", F.when(passes, engagement)), catalog, "_engagement", vector, top_n, only=passes)
        served = ranked.withColumns(outcome | {"items": F.when(passes, F.col("items")).otherwise(feed_array)})
    else:
        own = score(routed.filter(passes)).withColumn("_engagement", engagement)
        ranked = rank_items(own, catalog, "_engagement", vector, top_n).withColumns(outcome).select(*keep, "items")
        fed = routed.filter(~passes).withColumns(outcome | {"items": feed_array})
        served = ranked.unionByName(fed.select(*keep, "items"))
    return explode_items(served, keep)


def fallback_rate(routed: DataFrame) -> DataFrame:
    """Users and share per outcome."""
    per = routed.groupBy(F.coalesce("fallback_reason", F.lit("personalized")).alias("reason")).agg(
        F.count("*").alias("n")
    )
    # At most four outcomes reach this window.
    everything = Window.partitionBy(F.lit(0))
    return per.withColumn("share", F.col("n") / F.sum("n").over(everything))
