"""Prefix trie of rebuilt conversations by composable monoid fingerprints.

A conversation is rebuilt from the head of another (its base) and its own turns
after its head. No rebuilt text is made. A sequence of turns has a fingerprint in
a monoid: its length n and, in four lanes modulo a prime, the sum of its turns'
hashes weighted with powers of a lane's base; ``(n, s) * (m, t) = (n + m, s + base^n t)``.
Products of all prefixes come from one sorted exchange of the turns, scanned in
runs per partition whose totals are multiplied on. The product of a suffix is a
quotient of two prefixes, so the fingerprint of every rebuilt prefix is composed
from a head's product and two of the conversation's own.

Rebuilt prefixes of one fingerprint and depth are one node. That is verified, not
assumed: all members' last turns must have one hash pair, and where they refer to
different stored turns, those turns' roles and texts are compared. By induction
over the depth the whole sequences are equal; a difference is an error.

A node belongs to its smallest member, which then also owns the rest of its own
path: the trie falls into chains, one per conversation. A chain's total is added
once at each chain above, at the depth where the path leaves it, and suffix sums
along the chains give every subtree: no rounds, whatever the depth. A path meets
at most as many chains as it has turns.

Turns are ordered by number, null first, equal numbers by the hash of their
content; repeated rows are turns of their own. A null role or text is empty. Rows
without a conversation id are of no conversation and are left out. A conversation
whose turns are all replaced by a missing head has none and ends at the root. An
empty table gives no rows, not even a root. Other columns of any name do not
matter. A conversation, turn or node may hold any share of the rows: counting and
summing combine before they are exchanged, ids of a node are hashed in streamed
chunks, and joins on a hot node or conversation are left to Spark's skew handling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsefeed.llm.common import WORD_PATTERN, keep, text_or_empty
from pulsefeed.operators.scan import sliced_running

GROUP = 20
MAX_HEAD = 3
PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525, 69_069, 630_360_016)
LANES = [f"s{k}" for k in range(len(BASES))]
_INVERSE = [pow(b, PRIME - 2, PRIME) for b in BASES]
_CHUNK_IDS = 50_000
_DEPTH_SLICE = 4096


def powers(bases: tuple | list, n: np.ndarray) -> list[np.ndarray]:
    """base^n modulo the prime, a lane each."""
    out = []
    for base in bases:
        value, square, left = np.ones(len(n), np.int64), base, n.copy()
        while left.any():
            value = np.where(left & 1, value * square % PRIME, value)
            square, left = square * square % PRIME, left >> 1
        out.append(value)
    return out


def shifted(lanes: list[np.ndarray], by: np.ndarray) -> list[np.ndarray]:
    """The sums as they stand ``by`` turns later (or earlier, if negative)."""
    later, sooner = powers(BASES, np.maximum(by, 0)), powers(_INVERSE, np.maximum(-by, 0))
    return [s * a % PRIME * b % PRIME for s, a, b in zip(lanes, later, sooner)]


def _lanes_of(h1: np.ndarray, h2: np.ndarray) -> list[np.ndarray]:
    """Four 31-bit values of a turn from its two hashes."""
    mask = PRIME
    return [(h1 & mask) % PRIME, (h1 >> 31 & mask) % PRIME, (h2 & mask) % PRIME, (h2 >> 31 & mask) % PRIME]


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]


def numbered(turns: DataFrame) -> DataFrame:
    """(part, ref, conv_id, k, s0..s3, h1, h2, words, role, text): local place and prefix product of every turn.

    One exchange by range; a conversation may lie in several partitions. ``ref`` names the stored turn.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit("second"), text, role).alias("h2"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
        role.alias("role"),
        text.alias("text"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2"), F.col("tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    rows = rows.select("part", "conv_id", "h1", "h2", "words", "role", "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count, sums, seen = None, 0, [0] * len(LANES), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            part, conv, h1, h2 = _columns(batch, ["part", "conv_id", "h1", "h2"])
            starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            goes_on = conv[0] == last
            k = np.arange(n) - starts[group] + 1
            k[group == 0] += count if goes_on else 0
            lanes = []
            for j, (t, p) in enumerate(zip(_lanes_of(h1, h2), powers(BASES, k - 1))):
                total = np.cumsum(t * p % PRIME)
                before = np.append(0, total)[starts]
                s = total - before[group]
                s[group == 0] += sums[j] if goes_on else 0
                lanes.append(s % PRIME)
            last, count, sums = conv[-1], int(k[-1]), [int(s[-1]) for s in lanes]
            ref = (part.astype(np.int64) << 40) + seen + np.arange(n)
            seen += n
            columns = {"part": batch["part"], "ref": ref, "conv_id": batch["conv_id"], "k": k} | dict(zip(LANES, lanes))
            yield pa.RecordBatch.from_pydict(columns | {c: batch[c] for c in ("h1", "h2", "words", "role", "text")})

    lanes = ", ".join(f"{s} long" for s in LANES)
    return keep(rows.mapInArrow(scan, f"part int, ref long, conv_id long, k long, {lanes}, h1 long, h2 long, words long, role string, text string"), "turns")


def prefixes(made: DataFrame) -> DataFrame:
    """(ref, conv_id, i, s0..s3, h1, h2, words): the product of the first ``i`` turns of each conversation.

    Runs of a conversation in later partitions are multiplied from the left with
    the runs before; only conversations that lie in several partitions have any.
    """
    runs = made.groupBy("conv_id", "part").agg(F.max("k").alias("n"), F.max_by(F.struct(*LANES), "k").alias("s"))
    runs = runs.withColumn("parts", F.count("*").over(Window.partitionBy("conv_id"))).filter("parts > 1")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", "s.*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"))

    def at_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = shifted(_columns(batch, LANES), _columns(batch, ["n_before"])[0])
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in ("conv_id", "part", "n_before")} | dict(zip(LANES, moved)))

    placed = runs.mapInArrow(at_place, "conv_id long, part int, n_before long, " + ", ".join(f"{s} long" for s in LANES))
    carried = [(F.coalesce(F.sum(s).over(before), F.lit(0)) % PRIME).alias(f"c_{s}") for s in LANES]
    carry = keep(placed.select(F.col("conv_id").alias("c_conv"), F.col("part").alias("c_part"), "n_before", *carried), "carries")
    # A partition has two such conversations at most: its first and its last.
    joined = made.join(F.broadcast(carry), (F.col("conv_id") == F.col("c_conv")) & (F.col("part") == F.col("c_part")), "left")
    joined = joined.na.fill(0, ["n_before", *[f"c_{s}" for s in LANES]])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (n,) = _columns(batch, ["n_before"])
            moved = shifted(_columns(batch, LANES), n)
            lanes = [(a + b) % PRIME for a, b in zip(moved, _columns(batch, [f"c_{s}" for s in LANES]))]
            columns = {"ref": batch["ref"], "conv_id": batch["conv_id"], "i": batch["k"].to_numpy() + n} | dict(zip(LANES, lanes))
            yield pa.RecordBatch.from_pydict(columns | {c: batch[c] for c in ("h1", "h2", "words")})

    wanted = joined.select("ref", "conv_id", "k", *LANES, "h1", "h2", "words", "n_before", *[f"c_{s}" for s in LANES])
    lanes = ", ".join(f"{s} long" for s in LANES)
    return keep(wanted.mapInArrow(multiply, f"ref long, conv_id long, i long, {lanes}, h1 long, h2 long, words long"), "prefixes")


def head_length(conv_id: Column) -> Column:
    """How many turns are taken from the base: the CRC-32 of the decimal id modulo four."""
    return (F.crc32(conv_id.cast("string")) % (MAX_HEAD + 1)).cast("long")


def rebuilds(own: DataFrame) -> DataFrame:
    """(conv_id, h, taken, depth, head, q0..q3, p0..p3) of every conversation.

    ``head``: the base's first turns with their products; ``taken`` of them are used.
    q: product of those; p: product of the own head that they replace; ``depth``: turns of the rebuilt conversation.
    """
    turn = F.struct("i", *LANES, "h1", "h2", "words", "ref")
    heads = own.filter(F.col("i") <= MAX_HEAD).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("head"))
    sizes = own.groupBy("conv_id").agg(F.max("i").alias("n"))
    convs = sizes.join(heads, "conv_id").select("conv_id", "n", F.col("head").alias("own_head"), head_length(F.col("conv_id")).alias("h"))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    bases = heads.select(F.col("conv_id").alias("base"), "head")
    convs = convs.join(bases, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.slice("own_head", 1, 0)), 1, F.col("h").cast("int")))
    convs = convs.withColumn("taken", F.size("head").cast("long"))
    replaced = F.least("n", "h").cast("int") - 1
    product = lambda turns, at, s: F.coalesce(F.when(at >= 0, F.get(turns, at)[s]), F.lit(0).cast("long"))
    return keep(
        convs.select(
            "conv_id", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth"), "head",
            *[product("head", F.col("taken").cast("int") - 1, s).alias(f"q_{s}") for s in LANES],
            *[product("own_head", replaced, s).alias(f"p_{s}") for s in LANES],
        ),
        "rebuilds",
    )


def rebuilt(own: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, d, s0..s3, h1, h2, words, ref): every prefix of every rebuilt conversation, by fingerprint and last turn."""
    head = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.i").alias("d"), *[f"t.{s}" for s in LANES], "t.h1", "t.h2", "t.words", "t.ref")
    parts = [f"q_{s}" for s in LANES] + [f"p_{s}" for s in LANES]
    tail = own.join(convs.select("conv_id", "h", "taken", *parts), "conv_id").filter(F.col("i") > F.col("h"))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, h, taken = _columns(batch, ["i", "h", "taken"])
            whole, q, p = (_columns(batch, [f"{x}{s}" for s in LANES]) for x in ("", "q_", "p_"))
            # The own suffix is the whole prefix without the replaced head; it moves to the end of the taken head.
            suffix = shifted([(a - b) % PRIME for a, b in zip(whole, p)], taken - h)
            lanes = [(a + b) % PRIME for a, b in zip(q, suffix)]
            columns = {"conv_id": batch["conv_id"], "d": taken + i - h} | dict(zip(LANES, lanes))
            yield pa.RecordBatch.from_pydict(columns | {c: batch[c] for c in ("h1", "h2", "words", "ref")})

    lanes = ", ".join(f"{s} long" for s in LANES)
    tail = tail.select("conv_id", "i", "h", "taken", *LANES, *parts, "h1", "h2", "words", "ref")
    tail = tail.mapInArrow(compose, f"conv_id long, d long, {lanes}, h1 long, h2 long, words long, ref long")
    return keep(head.unionByName(tail), "rebuilt")


def verify(groups: DataFrame, rows: DataFrame, made: DataFrame) -> None:
    """Raise if members of a node do not end with the same turn.

    Members that refer to one stored turn agree; where references differ, the turns they name are read and compared.
    """
    unlike = groups.filter("n_convs > 1 AND (h1 <> h1_max OR h2 <> h2_max)")
    differing = groups.filter("ref <> ref_max").select("d", *LANES)
    named = rows.select("d", *LANES, "ref").join(differing, ["d", *LANES], "left_semi").select("ref").distinct()
    content = made.join(named, "ref", "left_semi").groupBy("h1", "h2").agg(
        F.min("text").alias("a"), F.max("text").alias("b"), F.min("role").alias("x"), F.max("role").alias("y")
    )
    if not unlike.isEmpty() or not content.filter("a <> b OR x <> y").isEmpty():
        raise ValueError("turns with equal fingerprints differ: choose other bases")


def hashed_ids(ends: DataFrame) -> DataFrame:
    """(owner, d, ends_sha256) from rows (owner, d, conv_id): the hash of a node's ascending ids, joined by commas.

    Ids are exchanged by range and joined to chunks where they arrive; a node's
    chunks are hashed one after the other, so no task holds a node's ids.
    """
    rows = ends.repartitionByRange("owner", "d", "conv_id").sortWithinPartitions("owner", "d", "conv_id").withColumn("part", F.spark_partition_id())

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            owner, d, ids = _columns(batch, ["owner", "d", "conv_id"])
            starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (d[1:] != d[:-1])])
            edges = np.unique(np.concatenate([starts, np.arange(0, len(ids), _CHUNK_IDS), [len(ids)]]))
            text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(edges, edges[1:])]
            begin, n = edges[:-1], len(edges) - 1
            yield pa.RecordBatch.from_pydict({"owner": owner[begin], "d": d[begin], "part": np.full(n, batch["part"][0].as_py(), np.int32), "place": at + np.arange(n), "ids": text})
            at += n

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ((key, t) for b in batches for key, t in zip(zip(b["owner"].to_pylist(), b["d"].to_pylist()), b["ids"]))
        out = []
        for (owner, d), texts in groupby(chunks, lambda x: x[0]):
            sha = hashlib.sha256(next(texts)[1].as_buffer())
            for _, text in texts:
                sha.update(b",")
                sha.update(text.as_buffer())
            out.append((owner, d, sha.hexdigest()))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pydict(dict(zip(("owner", "d", "ends_sha256"), map(list, zip(*out)))))
                out = []
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(("owner", "d", "ends_sha256"), map(list, zip(*out)))))

    chunks = rows.mapInArrow(chunk, "owner long, d long, part int, place long, ids string").repartition("owner", "d")
    return chunks.sortWithinPartitions("owner", "d", "part", "place").mapInArrow(digest, "owner long, d long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    made = numbered(turns)
    own = prefixes(made)
    convs = rebuilds(own)
    rows = rebuilt(own, convs)
    node = ["d", *LANES]
    groups = keep(
        rows.groupBy(*node).agg(
            F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
            *[f(c).alias(f"{c}{end}") for c in ("h1", "h2", "ref") for f, end in ((F.min, ""), (F.max, "_max"))],
        ),
        "nodes",
    )
    verify(groups, rows, made)
    nodes = groups.select("owner", "d", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))

    # Where a path runs in chains of smaller conversations, and the last depth it shares with each.
    shared = groups.filter("n_convs > 1").select(*node, "owner")
    above = rows.select("conv_id", *node).join(shared, node).filter("owner <> conv_id")
    above = keep(above.groupBy("conv_id", "owner").agg(F.max("d").alias("d")), "chains-above")
    parents = keep(above.groupBy("conv_id").agg(F.max_by("owner", "d").alias("owner"), F.max("d").alias("d")), "chain-parents")

    # Paths that end where they are shared leave no chain.
    leaving = parents.join(convs.select("conv_id", "depth"), "conv_id").filter("d < depth")
    branches = leaving.groupBy("owner", "d").agg(F.count("*").alias("branches"), F.lit(None).cast("long").alias("parent"))
    firsts = leaving.select(F.col("conv_id").alias("owner"), (F.col("d") + 1).alias("d"), F.lit(None).cast("long").alias("branches"), F.col("owner").alias("parent"))
    sides = branches.unionByName(firsts).groupBy("owner", "d").agg(F.max("branches").alias("branches"), F.max("parent").alias("parent"))
    nodes = keep(nodes.join(sides, ["owner", "d"], "left").na.fill(0, ["branches"]), "nodes-branches")
    # A chain's last node is a leaf unless other chains leave it there; the others go on.
    chains = nodes.groupBy("owner").agg(F.sum("saved").alias("c_saved"), (F.max_by("branches", "d") == 0).cast("long").alias("c_leaves"), F.max("d").alias("c_depth"))
    chains = keep(chains, "chains")
    below = above.join(chains.withColumnRenamed("owner", "conv_id"), "conv_id").groupBy("owner", "d").agg(F.sum("c_saved").alias("b_saved"), F.sum("c_leaves").alias("b_leaves"))
    tips = chains.select("owner", F.col("c_depth").alias("d"), "c_leaves")
    nodes = nodes.join(below, ["owner", "d"], "left").join(tips, ["owner", "d"], "left").na.fill(0, ["b_saved", "b_leaves"])
    nodes = nodes.withColumn("slice", -F.floor(F.col("d") / _DEPTH_SLICE))
    summed = sliced_running(
        nodes, ["owner"], ["slice"], [F.col("d").desc()],
        {"saved_tokens": ("sum", F.col("saved") + F.col("b_saved")), "n_leaves": ("sum", F.coalesce("c_leaves", F.lit(0)) + F.col("b_leaves"))},
    )

    root = convs.agg(F.min("conv_id").alias("owner"), F.count("*").alias("n")).first()
    if not root.n:
        return turns.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    tops = nodes.filter("d = 1").count()
    whole = chains.agg(F.sum("c_saved").alias("saved"), F.sum("c_leaves").alias("leaves")).first()
    long = lambda x: F.lit(x).cast("long")
    inner = summed.select(
        "owner", "d",
        # The first own node of a chain hangs on the chain it leaves, or on the root; the others on their own chain.
        F.coalesce("parent", F.when(F.col("d") == 1, long(root.owner)).otherwise(F.col("owner"))).alias("parent_conv_id"),
        "n_convs", (F.col("branches") + F.col("c_leaves").isNull().cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
    )
    top = turns.sparkSession.range(1).select(
        long(root.owner).alias("owner"), long(0).alias("d"), long(None).alias("parent_conv_id"), long(root.n).alias("n_convs"), long(tops).alias("n_children"),
        long(whole.leaves or 1).alias("n_leaves"), long(whole.saved or 0).alias("saved_tokens"),
    )
    last = convs.select("conv_id", "depth").join(parents.select("conv_id", F.col("owner").alias("above"), F.col("d").alias("above_d")), "conv_id", "left")
    at = F.when(F.col("depth") == 0, long(root.owner)).when(F.coalesce("above_d", F.lit(0)) < F.col("depth"), F.col("conv_id")).otherwise(F.col("above"))
    ends = hashed_ids(last.select(at.alias("owner"), F.col("depth").alias("d"), "conv_id"))
    out = inner.unionByName(top).join(ends, ["owner", "d"], "left")
    return out.select(
        F.col("owner").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
