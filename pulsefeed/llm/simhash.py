"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are packed into tiles by the population counts of their
blocks of bits; blocks are halved one by one as the table grows, so tiles keep
their size and there are about as many as the rows need. Two fingerprints within the radius have block counts whose sum of
differences is within it too, so tile pairs farther apart are skipped without
loss; the rest are compared whole with numpy exclusive-or and bit counts. A pair
of tiles gives a spanning forest of its links, never all of them: the components
are the same and a dense group costs no more rows than it has fingerprints.

Equal fingerprints are one node however many rows carry them. Null and empty
texts have fingerprint zero and are linked like any other; a text of fewer words
than a shingle is one shingle. Null ids never name a component unless it has no
other; repeated rows belong to one component. Empty tables give empty results.
Joins of the rows with their fingerprint's component, of which one may hold any
share of the rows, are left to Spark's skew handling: the other side is small.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat
from math import ceil, comb, floor, prod, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.common import held, keep

SHINGLE = 3
RADIUS = 2
SEED = 42
BITS = 64
TILE_ROWS = 4096
# Rows that a tile is meant to hold, and how many times as many uneven ones may before blocks are halved further.
TARGET_ROWS = 2048
UNEVEN = 4
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNK = 1 << 16
# Comparisons at a time: what fits a core's cache.
_COMPARED = 1 << 17


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of the word shingles, repeats included; 0 without words."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as signed longs."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return of(text)


def refined(widths: list[int]) -> list[int] | None:
    """One block more: the first of the widest is halved. None if all have one bit."""
    widest = max(widths)
    if widest == 1:
        return None
    at = widths.index(widest)
    return [*widths[:at], widest // 2, widest - widest // 2, *widths[at + 1 :]]


def even_rows(n: int, widths: list[int]) -> float:
    """Rows that share a row's block counts, among ``n`` even fingerprints."""
    return n * prod(comb(2 * w, w) / 4**w for w in widths)


def choose_widths(distinct: DataFrame, n: int, target: int = TARGET_ROWS) -> list[int]:
    """Widths of the blocks: halved one at a time until a row shares its tile with about ``target`` others.

    First by what even fingerprints would do, then by the counts themselves, so
    bits that go together only mean more blocks. A halving cuts tiles to a fifth
    to a third, at any size of the table.
    """
    widths = [BITS]
    while even_rows(n, widths) > target and refined(widths):
        widths = refined(widths)
    while n > target and (finer := refined(widths)):
        crowd = distinct.groupBy(_tile_key(F.col("fp"), widths).alias("tile")).count()
        if crowd.agg(F.sum(F.col("count").cast("double") * F.col("count"))).first()[0] <= UNEVEN * target * n:
            break
        widths = finer
    return widths


def _ball(blocks: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of block counts within the radius: steps of one block at a time, so any number of blocks is cheap."""
    found = {(0,) * blocks}
    for _ in range(radius):
        found |= {v[:i] + (v[i] + s,) + v[i + 1 :] for v, i, s in product(list(found), range(blocks), (1, -1))}
    return sorted(found)


def _tile_key(fp: Column, widths: list[int]) -> Column:
    """The population counts of the blocks, as text.

    Counts beyond two standard deviations are drawn in to them: that never makes
    two counts differ more, and the many rare keys become few.
    """
    counts, at = [], 0
    for w in widths:
        block = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit(-1 if w == 64 else (1 << w) - 1).cast("long"))
        low, high = ceil(w / 2 - sqrt(w)), floor(w / 2 + sqrt(w))
        counts.append(F.greatest(F.least(F.bit_count(block), F.lit(high)), F.lit(low)).cast("string"))
        at += w
    return F.concat_ws(",", *counts)


def _links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or within one): grown from each node to all it reaches."""
    nodes = np.unique(np.concatenate([a, b]))
    left, right = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    label = np.arange(len(nodes))
    u: list[int] = []
    v: list[int] = []
    rows = max(1, _COMPARED // max(1, len(b)))
    for at in range(0, len(a), rows):
        near = np.bitwise_count(a[at : at + rows, None] ^ b[None, :]) <= radius
        near &= left[at : at + rows, None] != right[None, :]
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            x = left[at + i]
            others = right[near[i]]
            new = others[label[others] != label[x]]
            if len(new):
                merged, first = np.unique(label[new], return_index=True)
                u += [x] * len(first)
                v += new[first].tolist()
                label[np.isin(label, merged)] = label[x]
    return nodes[u].view(np.int64), nodes[v].view(np.int64)


def links(
    distinct: DataFrame, n: int, radius: int = RADIUS, tile_rows: int = TILE_ROWS, widths: list[int] | None = None
) -> DataFrame:
    """(u, v): links enough to connect what the radius connects, from one row ``fp`` per fingerprint."""
    widths = widths or choose_widths(distinct, n)
    keyed = distinct.select("fp", _tile_key(F.col("fp"), widths).alias("tile"))
    # Equal counts beyond a tile's rows go on to more tiles; the parts are even hashes of the bits.
    # Only the few keys with such a crowd are joined, and rows are dealt by key and part together.
    crowded = keyed.groupBy("tile").count().filter(F.col("count") > tile_rows)
    crowded = crowded.select("tile", F.ceil(F.col("count") / tile_rows).alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1)))
    parted = keyed.join(crowded, "tile", "left").select("fp", F.concat("tile", F.lit("/"), part).alias("place"))

    def pack(got: pa.Table) -> pa.Table:
        data = np.sort(got["fp"].to_numpy()).tobytes()
        return pa.table({"place": got["place"][:1], "data": pa.array([data], pa.binary())})

    packed = parted.groupBy("place").applyInArrow(pack, "place string, data binary")
    place = F.split("place", "/")
    tiles = keep(packed.select(place[0].alias("tile"), place[1].cast("long").alias("part"), "data"), "simhash-tiles")
    steps = F.array(*[F.array(*[F.lit(x) for x in v]) for v in _ball(len(widths), radius) if v >= (0,) * len(widths)])
    digits = F.split("tile", ",").cast("array<int>")
    near = F.explode(F.transform(steps, lambda v: F.concat_ws(",", F.zip_with(digits, v, lambda x, y: x + y).cast("array<string>"))))
    ids = tiles.select("tile", "part")
    other = ids.select(F.col("tile").alias("tile_b"), F.col("part").alias("part_b"))
    pairs = ids.withColumn("tile_b", near).join(other, "tile_b")
    pairs = pairs.filter((F.col("tile") != F.col("tile_b")) | (F.col("part") <= F.col("part_b")))
    both = pairs.join(tiles.withColumnRenamed("data", "a"), ["tile", "part"])
    both = both.join(tiles.select(F.col("tile").alias("tile_b"), F.col("part").alias("part_b"), F.col("data").alias("b")), ["tile_b", "part_b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch["a"], batch["b"]):
                u, v = _links(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), radius)
                if len(u):
                    yield pa.RecordBatch.from_pydict({"u": u, "v": v})

    spread = both.select("a", "b").repartition(distinct.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.mapInArrow(compare, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node each linked node reaches, by alternating stars over written tables.

    Large star: every greater neighbour of a node is linked to the least one.
    Small star: every lesser neighbour and the node itself likewise. Both only
    take a minimum per node and a join on it, so a hub is combined map-side and
    its edges may be split over tasks.
    """
    edges = keep(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    last = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        large = keep(large, "large-star")
        down = large.select(F.col("v").alias("x"), F.col("u").alias("y"))
        least = down.groupBy("x").agg(F.min("y").alias("m"))
        small = down.join(least, "x").select("m", F.explode(F.array("x", "y")).alias("b"))
        small = small.filter("m <> b").select(F.least("m", "b").alias("u"), F.greatest("m", "b").alias("v")).distinct()
        edges = keep(small, "small-star")
        # Stars are fixed points of both steps: then every node has one edge, to its root.
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == last:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        last = state


def near_duplicates(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints`` (a kept table with ``doc_id`` and ``fp``) with ``component_id``, the least id reachable."""
    distinct = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), distinct.count(), radius))
    known = distinct.join(roots, F.col("fp") == F.col("node"), "left")
    known = known.select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    names = known.join(named, "root").select(F.col("fp").alias("of_fp"), "component_id", "root")
    return prints.join(names, F.col("fp") == F.col("of_fp")).drop("of_fp")


def simhash(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row."""
    prints = keep(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "simhash-prints")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return near_duplicates(prints, radius).select("doc_id", shown, "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component: the one of least id (then of least hash of the row); a copy of the row counts as the row."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    prints = docs.select("doc_id", whole.alias("whole"), fingerprints(F.col("text"), shingle).alias("fp"))
    grouped = near_duplicates(keep(prints, "simhash-prints"), radius)
    first = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "whole")
    chosen = grouped.groupBy("root").agg(F.min(first).alias("k")).select("k.doc_id", "k.whole")
    copies = grouped.groupBy("doc_id", "whole").count()
    chosen = chosen.join(copies, chosen.whole.eqNullSafe(copies.whole) & chosen.doc_id.eqNullSafe(copies.doc_id)).select(
        chosen.doc_id.alias("c_id"), chosen.whole.alias("c_whole"), F.col("count").alias("c_count")
    )
    chosen = keep(chosen, "simhash-chosen")
    rows = held(docs).withColumn("whole", F.xxhash64(*[F.col(f"row.`{c}`") for c in docs.columns]))
    rows = rows.join(chosen, (F.col("whole") == F.col("c_whole")) & F.col("row.doc_id").eqNullSafe(F.col("c_id")))
    single = rows.filter("c_count = 1").select("row")
    if chosen.filter("c_count > 1").isEmpty():
        return single.select("row.*")
    return single.union(rows.filter("c_count > 1").groupBy("c_id", "c_whole").agg(F.first("row").alias("row")).select("row")).select("row.*")
