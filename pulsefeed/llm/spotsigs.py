"""SpotSigs document fingerprints, in DataFrame functions only.

Common words are anchors. The content word after an anchor (or at the start) and
the content words that follow it, anchors between them skipped, form a chain; so
does every content word with no anchor among the ``STRETCH`` words before it, so
text without anchors is fingerprinted whole. The hashes of a text's distinct
chains, sorted, are its fingerprint. Likeness is the Jaccard coefficient of two
fingerprints. Words beyond the chain but within the stretch after an anchor are
what a fingerprint does not see.

``similar`` finds all pairs of classes of equal fingerprints at or above a
likeness: sets are partitioned by their length so that only a partition and the
next can match, candidates share one of their rarest signatures (enough of them
that no pair is missed), lengths prune, and the rest is compared exactly.

A null text counts as empty and has the empty fingerprint; a text of common words
only has one signature, of the whole text. Two empty fingerprints are alike (1),
an empty and another are not (0). Rows with equal ids are ordered by the hash of
their text (and of a tie number, if they are too many for a bucket); null ids come
last. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsefeed.llm.common import bucket_of, keep, longs, text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CHAIN = 3
STRETCH = 8
SIMILAR = 0.8
BUCKET_ROWS = 1_000
MAX_BUCKETS = 10_000
SALTS = 16
# An id with more rows than so many buckets is cut.
_CROWDED = 4
LOW = -(1 << 63)

# Anchors: the commonest words of four languages; a parameter of the fingerprint.
COMMON_WORDS = tuple(
    (
        "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their there they "
        "this to was were which will with you "
        "aber als am auch auf aus bei bin das dass dem den der des die du ein eine einem einen einer es für hat ich ihr im ist "
        "mit nach nicht noch oder sich sie sind so und von vor war wie wir zu zum zur "
        "al como con del el ella en era es esta este la las lo los más no o para pero por que se sin sobre su sus un una y ya "
        "au aux avec ce ces cette dans de des du elle est et il ils je le les leur mais ne nous ou par pas plus pour qui sa "
        "ses son sur une vous"
    ).split()
)


def with_signatures(df: DataFrame, text: str, name: str, common: tuple = COMMON_WORDS, chain: int = CHAIN) -> DataFrame:
    """``name``: sorted distinct 64-bit hashes of the chains of the (non-null) column ``text``.

    The steps are columns one after the other, so no lambda computes its array again.
    """
    words, chains = f"{name}_words", f"{name}_chains"
    split = F.array_remove(F.split(F.lower(text), SEPARATORS), "")
    df = df.withColumn(words, F.transform(split, lambda w: F.when(w.isin(*common), "").otherwise(w)))

    def opens(w: Column, i: Column) -> Column:
        before = F.get(F.col(words), i - 1)
        recent = F.slice(F.col(words), F.greatest(i - STRETCH, F.lit(0)) + 1, F.least(i, F.lit(STRETCH)))
        opening = (i == 0) | (before == "") | ~F.array_contains(recent, "")
        return F.when(w != "", F.when(opening, F.concat(F.lit("^"), w)).otherwise(w))

    df = df.withColumn(chains, F.array_compact(F.transform(F.col(words), opens)))

    def hashed(w: Column, i: Column) -> Column:
        following = [F.ltrim(F.get(F.col(chains), i + k), F.lit("^")) for k in range(1, chain)]
        return F.when(F.startswith(w, F.lit("^")), F.xxhash64(w, *following))

    spots = F.array_sort(F.array_distinct(F.array_compact(F.transform(F.col(chains), hashed))))
    bare = F.when(F.col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.lower(text))))
    return df.withColumn(name, F.when(F.size(chains) > 0, spots).otherwise(bare)).drop(words, chains)


def shown(signatures: str) -> Column:
    return F.concat_ws(" ", F.col(signatures).cast("array<string>"))


def likeness(a: str, b: str) -> Column:
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, 1.0).otherwise(common / every)


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, Window]:
    """(id, text, bucket, place, guest) and the window in which the next row is the next document by descending id.

    Ids are cut into buckets of rows at approximate quantiles. Each bucket also
    gets a guest: the first document of the bucket that follows (after the last
    one: of the first). One exchange then brings every document beside its next,
    and no task sees more than a bucket (beyond ``MAX_BUCKETS`` times
    ``bucket_rows`` rows, buckets grow with the table). If an id, or the null,
    has more rows than a few buckets, the rows are stored with a tie number, and
    those of that id are cut by a hash of it. Rows with ``guest`` 1 are to be dropped.
    """
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOW))
    rows = docs.select("doc_id", ident.alias("id"), text_or_empty("text").alias("text"))
    n = docs.count()
    buckets = max(1, min(MAX_BUCKETS, n // bucket_rows))
    cuts = rows.agg(F.percentile_approx("id", [k / buckets for k in range(1, buckets)] or [0.5], 100 * buckets)).first()[0]
    bounds = [(c, LOW) for c in sorted(set(cuts or []))] if buckets > 1 else []
    rows = rows.withColumn("place", F.xxhash64("text"))
    size = max(bucket_rows, n // MAX_BUCKETS)
    often = rows.groupBy("id").count().filter(F.col("count") > _CROWDED * size).collect()  # n / size rows at most
    if often:
        rows = keep(rows.withColumn("place", F.xxhash64("text", F.monotonically_increasing_id())), "spotsigs-rows")
        for r in often:
            parts = -(-r["count"] // size)
            bounds += [(r["id"], LOW + (k << 64) // parts) for k in range(parts)]
        bounds = sorted(set(bounds))
    rows = rows.withColumn("bucket", bucket_of(F.col("id"), F.col("place"), bounds))
    tops = dict(rows.groupBy("bucket").agg(F.max("id")).collect())
    order = sorted(tops, reverse=True)
    receiver = {b: order[k - 1] for k, b in enumerate(order)}  # the first document of b follows the last of the bucket before
    firsts = rows.filter(F.col("id") == F.get(longs([tops.get(b, 0) for b in range(len(bounds) + 1)]), F.col("bucket")))
    firsts = firsts.groupBy("bucket").agg(F.max_by("text", "place").alias("text"))
    goes_to = F.get(longs([receiver.get(b, 0) for b in range(len(bounds) + 1)]), F.col("bucket")).cast("int")
    guests = firsts.select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.lit(LOW).alias("id"), "text",
        goes_to.alias("bucket"), F.lit(LOW).alias("place"), F.lit(1).alias("guest"),
    )
    rows = rows.withColumn("guest", F.lit(0)).unionByName(guests)
    return rows, Window.partitionBy("bucket").orderBy("guest", F.desc("id"), F.desc("place"))


def edits(docs: DataFrame, common: tuple = COMMON_WORDS, chain: int = CHAIN) -> DataFrame:
    """Every document, the text with its second half replaced from the next document, and the likenesses."""
    rows, window = with_next(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("next", F.lead("text").over(window))
    rows = rows.withColumn("edited", F.concat(F.left("text", n - half), F.left(F.coalesce("next", F.lit("")), half)))
    rows = with_signatures(rows.drop("next"), "text", "own", common, chain)
    rows = rows.withColumn("following", F.lead("own").over(window)).filter("guest = 0")
    rows = with_signatures(rows, "edited", "other", common, chain)
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        shown("own").alias("fingerprint"),
        shown("other").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
    )


def classes(docs: DataFrame) -> DataFrame:
    """Membership: (doc_id, class_id, class_key, own): the least id of the documents with an equal fingerprint, and what tells classes apart.

    ``class_id`` is a label: null if all ids of the class are, and not unique if ids
    repeat with different texts. ``class_key``, two hashes of the fingerprint, is.
    """
    rows = with_signatures(docs.select("doc_id", text_or_empty("text").alias("text")), "text", "own")
    key = F.struct(F.xxhash64("own").alias("h"), F.hash("own").alias("h2")).alias("class_key")
    rows = keep(rows.select("doc_id", "own", key), "spotsigs")
    # A class may hold a third of all rows: its name is sent in parts, each beside its share of the rows.
    named = rows.groupBy("class_key").agg(F.min("doc_id").alias("class_id"))
    named = named.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS)).cast("int"))
    return rows.join(named, ["class_key", "salt"]).select("doc_id", "class_id", "class_key", "own")


def similar(members: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(a_key, b_key, a, b, likeness): all pairs of different classes at ``least`` or above, from ``classes``; (a, a_key) < (b, b_key).

    A set of n signatures can only match lengths up to n / least, which is its own
    length partition or the next. Of any matching pair both hold a common signature
    among their n - ceil(least n) + 1 rarest, and the place of the first such one in
    both bounds what they can still share: candidates below that bound are dropped
    before they are exchanged, so a signature that many classes hold costs the
    comparison of two places a pair.
    """
    sets = members.groupBy("class_key").agg(F.first("own").alias("own"), F.min("class_id").alias("class_id"))
    sets = keep(sets.filter(F.size("own") > 0), "spotsigs-sets")
    each = sets.select("class_key", "class_id", F.size("own").alias("n"), F.explode("own").alias("s"))
    often = each.groupBy("s").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("class_key").orderBy("df", "s"))
    level = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(1 / least)) + 1e-9).cast("int")
    rare = each.join(often, "s").withColumn("rank", rank).filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
    rare = rare.select(F.struct("class_id", "class_key").alias("b"), "n", "s", "rank", level.alias("level"))
    rare = keep(rare, "spotsigs-rare")
    probe = rare.select(
        F.col("b").alias("a"), F.col("n").alias("n_a"), F.col("rank").alias("rank_a"), "s",
        F.explode(F.array("level", F.col("level") + 1)).alias("level"),
    )
    found = probe.join(rare, ["s", "level"])
    found = found.filter((F.col("a.class_key") != F.col("b.class_key")) & (F.col("n_a") <= F.col("n")) & (F.col("n") * least <= F.col("n_a") + 1e-9))
    # Before this signature at most the smaller rank less one is common, after it at most the shorter rest.
    most = F.least("rank_a", "rank") + F.least(F.col("n_a") - F.col("rank_a"), F.col("n") - F.col("rank"))
    found = found.filter(most * (1 + least) >= (F.col("n_a") + F.col("n")) * least - 1e-9)
    pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = pairs.select(F.col("a.class_key").alias("a_key"), F.col("b.class_key").alias("b_key"))
    side = lambda x: sets.select(F.col("class_key").alias(f"{x}_key"), F.col("class_id").alias(x), F.col("own").alias(f"own_{x}"))
    both = pairs.join(side("a"), "a_key").join(side("b"), "b_key").withColumn("likeness", likeness("own_a", "own_b"))
    return both.filter(F.col("likeness") >= least - 1e-12).select("a_key", "b_key", "a", "b", "likeness")
