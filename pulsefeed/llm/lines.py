"""Line dedup by distinct-site spread, in DataFrame functions only.

A HyperLogLog sketch of the sites is kept per line hash and merged by
aggregation. Lines whose estimate is clearly above the threshold are boilerplate,
lines near it get an exact distinct count, and boilerplate lines are removed from
every document.

Lines are what newlines separate, compared as they are; blank lines are never
removed. A null text counts as empty; a null site does not count as a site.
Repeated rows add nothing to a line's spread. An empty table gives an empty
result. Other columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.common import keep, text_or_empty

MIN_SITES = 5
SKETCH_LG_K = 12
# Standard errors (1.04 / 2^(k/2)) around the threshold within which a line is counted exactly.
BAND_ERRORS = 8


def _key(line: Column) -> Column:
    """96 bits of hash: among 10^12 lines a collision is unlikely."""
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("h2"))


def _lines(text: Column) -> Column:
    return F.split(text_or_empty(text), "\n")


def spread_lines(docs: DataFrame, site: str, min_sites: int = MIN_SITES, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Keys (h, h2) of the lines that stand on at least ``min_sites`` sites."""
    each = docs.select(F.col(site).cast("string").alias("site"), F.explode(_lines(F.col("text"))).alias("line"))
    each = each.filter(F.trim("line") != "").select("site", _key(F.col("line")).alias("k")).select("site", "k.h", "k.h2")
    sketches = each.groupBy("h", "h2").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    band = max(1.0, BAND_ERRORS * 1.04 / 2 ** (lg_k / 2) * min_sites)
    estimated = sketches.select("h", "h2", F.hll_sketch_estimate("sketch").alias("sites")).filter(F.col("sites") >= min_sites - band)
    estimated = keep(estimated, "line-spread")
    sure = estimated.filter(F.col("sites") > min_sites + band).select("h", "h2")
    near = estimated.filter(F.col("sites") <= min_sites + band).select("h", "h2")
    exact = each.join(near, ["h", "h2"]).groupBy("h", "h2").agg(F.count_distinct("site").alias("sites"))
    return keep(sure.unionByName(exact.filter(F.col("sites") >= min_sites).select("h", "h2")), "boilerplate")


def without_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """(row, text, n_lines, n_removed): the cleaned text beside the document."""
    drop = spread_lines(docs, site, min_sites)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"))
    each = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"), F.explode(F.transform(_lines(F.col("text")), _key)).alias("k"))
    hits = each.select("id", "t", "k.h", "k.h2").join(drop, ["h", "h2"])
    hits = hits.groupBy("id", "t").agg(F.collect_set(F.struct("h", "h2")).alias("hits"))  # at most one document's lines
    hits = hits.select(F.col("id").alias("of_id"), F.col("t").alias("of_t"), "hits")
    joined = rows.join(hits, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("t") == F.col("of_t")), "left")
    lines = _lines(F.col("row.text"))
    goes = lambda x: F.array_contains(F.col("hits"), _key(x))
    kept = F.when(F.col("hits").isNull(), lines).otherwise(F.filter(lines, lambda x: ~goes(x)))
    out = joined.select("row", lines.alias("lines"), kept.alias("kept"))
    return out.select(
        "row",
        F.array_join("kept", "\n").alias("text"),
        F.size(F.filter("lines", lambda x: F.trim(x) != "")).cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )
