"""Sharding by histogram sort.

The key is (hash of the text, hash of the id), so equal texts are neighbours.
Exact bytes below candidate boundaries are counted over all partitions, the
candidates are refined between the nearest counted ones until every splitter is
within the tolerance of its target, and the rows are exchanged once. Splitters are
looked for between texts first; only a group of equal texts that is too large for
a shard's edge is cut, by the hash of the id. If rows equal in text and id are too
many for an edge, the rows are stored with a tie number and cut by that as well.

There are as many splitters as edges between shards, however large the corpus.
For the exchange a shard is dealt to pieces by a hash of the key, as many as keep
a piece small; slots run through the pieces one after the other, in key order in
each.

Law ``bytes``: sizes are near equal. A null text has no bytes of its own but the
8 of its row. An empty table has no shards. Other columns of any name pass through.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsefeed.llm.common import bucket_of, held, keep, text_or_empty

SHARDS = 24
ROW_BYTES = 8
TOLERANCE = 0.001
PROBES = 32
PIECE_BYTES = 64 << 20
MIN_PIECES = 3
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def key_of(doc_id: Column, text: Column, *tie: Column) -> tuple[Column, Column]:
    return F.xxhash64(text_or_empty(text)), F.xxhash64(doc_id, *tie)


def _between(lo: tuple[int, int], hi: tuple[int, int], n: int) -> list[tuple[int, int]]:
    """Up to ``n`` keys strictly between: at text edges while texts are left, within one text by id after that."""
    if hi[0] - lo[0] > 1:
        return sorted({(lo[0] + (hi[0] - lo[0]) * k // (n + 1), LOW) for k in range(1, n + 1)} - {lo, hi, (lo[0], LOW)})
    if hi[0] - lo[0] == 1:
        if lo < (hi[0], LOW) < hi:
            return [(hi[0], LOW)]
        top = HIGH + 1
    else:
        top = hi[1]
    return sorted({(lo[0], lo[1] + (top - lo[1]) * k // (n + 1)) for k in range(1, n + 1)} - {lo})


def splitters(
    stats: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, probes: int = PROBES
) -> tuple[list[tuple[int, int]], bool]:
    """Ascending keys that begin the 2nd, 3rd, ... of ``shards`` ranges of near equal size, and whether all are as near as rows allow.

    ``stats``: (h, id, size), read once per round. A splitter misses the tolerance
    (a share of a shard) only if a single key is larger; by more than a row only if
    several rows have that key.
    """
    total, largest = stats.agg(F.sum("size"), F.max("size")).first()
    total, largest = total or 0, largest or 0
    goals = {k: total * k / shards for k in range(1, shards)}
    slack = tolerance * total / shards
    counted = {(LOW, LOW): 0, (HIGH, HIGH): total}
    found: dict[int, tuple[int, int]] = {}
    met = True
    while total and len(found) < len(goals):
        known = sorted(counted)
        below = [counted[k] for k in known]
        wanted: set[tuple[int, int]] = set()
        for k, goal in goals.items():
            if k in found:
                continue
            at = min(max(bisect.bisect_right(below, goal), 1), len(known) - 1)
            lo, hi = known[at - 1], known[at]
            best = min((lo, hi), key=lambda x: abs(counted[x] - goal))
            near = abs(counted[best] - goal) <= slack
            more = [] if near else _between(lo, hi, probes)
            if more:
                wanted.update(more)
            else:
                found[k] = best
                met &= abs(counted[best] - goal) <= max(slack, largest)
        wanted = sorted(wanted - counted.keys())
        if not wanted:
            continue
        place = bucket_of(F.col("h"), F.col("id"), wanted)
        sums = dict(stats.groupBy(place.alias("place")).agg(F.sum("size")).collect())
        running = 0
        for i, k in enumerate(wanted):
            running += sums.get(i, 0)
            counted[k] = running
    return [found.get(k, (HIGH, HIGH)) for k in sorted(goals)], met


def _keyed(rows: DataFrame, *tie: Column) -> DataFrame:
    high, low = key_of(F.col("row.doc_id"), F.col("row.text"), *tie)
    return rows.select("row", high.alias("h"), low.alias("id"), size_of(F.col("row.text")).alias("size"))


def assign_shards(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(row, size, shard, slot): slots count from 0, without gaps."""
    rows = _keyed(held(docs))
    stats = keep(rows.select("h", "id", "size"), "shard-sizes")
    bounds, met = splitters(stats, shards, tolerance)
    if not met:
        rows = _keyed(keep(held(docs).withColumn("tie", F.monotonically_increasing_id()), "shard-ties"), F.col("tie"))
        stats = keep(rows.select("h", "id", "size"), "shard-sizes")
        bounds, _ = splitters(stats, shards, tolerance)
    total = stats.agg(F.sum("size")).first()[0] or 0
    pieces = max(MIN_PIECES, -(-total // (shards * piece_bytes)))
    at = [bucket_of(F.col("h"), F.col("id"), bounds).alias("shard"), F.pmod(F.xxhash64("h", "id"), F.lit(pieces)).alias("piece")]
    counts = stats.groupBy(*at).count()
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("h", "id"))
    out = rows.select("*", *at).join(starts, ["shard", "piece"]).withColumn("slot", F.col("start") + place - 1)
    return out.select("row", "size", "shard", "slot")


def shard(docs: DataFrame, **rule) -> DataFrame:
    """The documents with ``shard`` and ``slot``; columns of these names give way."""
    out = assign_shards(docs, **rule)
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")], "shard", "slot")
