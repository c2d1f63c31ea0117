"""Best-fit packing of tokenized documents by exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens; only longer ones are cut,
and the first piece takes the remainder. How many pieces of each length there are
is all the planning needs: at most ``capacity`` counts, however large the corpus.
The sums of one, two and three lengths are indexed by what they add up to. A
sequence starts with the longest piece left; its gap is filled exactly from the
index where the counts allow it, and the combination is consumed as many times
as they allow at once. Where nothing fits exactly, the longest piece that fits
goes in (best fit) and the smaller gap is tried again.

The plan says how many sequences have which lengths. The k-th piece of a length
(k runs over written partitions, from counts per partition and length) finds its
sequence and offset in it by search, so nothing is collected or sorted whole.

Null and empty texts are the end id alone. Null ids and repeated rows are packed
like others. A text of any length is encoded whole, in its own task. An empty
table gives no sequences. Only ``doc_id`` and ``text`` are read, so other columns
of any name do not matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsefeed.llm.common import keep, text_or_empty
from pulsefeed.llm.tokens import BATCH_BYTES, END_ID, encoder

CAPACITY = 2048
_RANK_BITS = 44


def cut(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: the remainder first, then full ones."""
    first = n % capacity or capacity
    return [min(n, first)] + [capacity] * ((n - 1) // capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], part, place) of every piece.

    ``place`` counts the pieces of the same length before it in its partition ``part``.
    """
    rows = docs.select("doc_id", text_or_empty("text").alias("text"), F.spark_partition_id().alias("part"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, place long"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(tokenizer), Counter()
        end = np.array([end_id], "<u4")
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                size = np.cumsum(pc.binary_length(batch["text"].slice(at)).to_numpy(zero_copy_only=False))
                n = max(1, int(np.searchsorted(size, BATCH_BYTES, "right")))
                out = []
                coded = encode.encode(batch["text"].slice(at, n).to_pylist())
                for doc_id, part, ids in zip(batch["doc_id"].slice(at, n).to_pylist(), batch["part"].slice(at, n).to_pylist(), coded):
                    ids, start = np.concatenate([ids, end]), 0
                    for k, length in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + length].tobytes()
                        out.append((doc_id, k, start, length, zlib.crc32(own), own if with_ids else None, part, seen[length]))
                        seen[length] += 1
                        start += length
                columns = list(map(list, zip(*out)))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "place")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
                at += n

    out = rows.mapInArrow(split, schema)
    return out if with_ids else out.drop("ids")


class ExactSums:
    """Counts of lengths, with the combinations of up to three that add up to a sum.

    Counts only ever fall, so a pair or triple that has run out never returns: one
    place per sum, moving past what has run out, is an index of all combinations.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = [0] * (capacity + 1)
        for length, n in counts.items():
            self.left[length] = n
        self.pairs = [s - 1 for s in range(capacity + 1)]
        self.triples = [s - 2 for s in range(capacity + 1)]
        self.longest = capacity

    def single(self, s: int) -> tuple[int, ...] | None:
        return (s,) if self.left[s] else None

    def pair(self, s: int) -> tuple[int, ...] | None:
        """The pair of sum ``s`` with the longest piece that is left."""
        left, a = self.left, self.pairs[s]
        while 2 * a >= s and a > 0 and not (left[a] and left[s - a] and (2 * a > s or left[a] > 1)):
            a -= 1
        self.pairs[s] = a
        return (a, s - a) if 2 * a >= s and a > 0 else None

    def triple(self, s: int) -> tuple[int, ...] | None:
        """A piece and a pair of no longer pieces, of sum ``s``."""
        left, a = self.left, self.triples[s]
        while 3 * a >= s and a > 0:
            if left[a] and self.pair(s - a):
                # The pair may want the piece itself: those need enough copies.
                b = min(self.pairs[s - a], a)
                while 2 * b >= s - a:
                    c = s - a - b
                    need = Counter((a, b, c))
                    if all(left[x] >= k for x, k in need.items()):
                        self.triples[s] = a
                        return (a, b, c)
                    b -= 1
            a -= 1
        self.triples[s] = a
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or self.pair(gap) or self.triple(gap)

    def best_fit(self, gap: int) -> int:
        """The longest piece left that is no longer than the gap; 0 if there is none."""
        self.longest = self._down(self.longest)
        return self._down(min(gap, self.longest))

    def _down(self, at: int) -> int:
        while at and not self.left[at]:
            at -= 1
        return at


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many sequences, the lengths in each) that use up ``counts``."""
    index = ExactSums({n: c for n, c in counts.items() if n < capacity}, capacity)
    plan = [(counts[capacity], [capacity])] if counts.get(capacity) else []
    while longest := index.best_fit(capacity):
        lengths, gap = [], capacity
        fill: tuple[int, ...] | None = (longest,)
        while fill:
            for x in fill:
                index.left[x] -= 1
            lengths += fill
            gap -= sum(fill)
            fill = index.exact(gap) if gap else None
            if gap and not fill:
                best = index.best_fit(gap)
                fill = (best,) if best else None
        need = Counter(lengths)
        more = min(index.left[x] // k for x, k in need.items())
        for x, k in need.items():
            index.left[x] -= k * more
        plan.append((more + 1, lengths))
    return plan


def slots(plan: list[tuple[int, list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of pieces of one length: (length and first rank in one number, first sequence, offset), ascending."""
    rows, taken, sequence = [], Counter(), 0
    for times, lengths in plan:
        offset = 0
        for length in lengths:
            rows.append(((length << _RANK_BITS) + taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    rows.sort()
    keys, first, offset = np.array(rows, np.int64).reshape(-1, 3).T
    return keys, first, offset


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every piece."""
    made = keep(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    cells = keep(made.groupBy("part", "length").count(), "piece-counts")
    counts = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    keys, first, offsets = slots(plan_packing(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = cells.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = made.join(begins, ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"][: int(with_ids)]]
    ranked = ranked.select(*kept, "rank")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rank = batch["rank"].to_numpy()
            key = (batch["length"].to_numpy() << _RANK_BITS) + rank
            at = np.searchsorted(keys, key, "right") - 1
            columns = {c: batch[c] for c in kept}
            columns |= {"sequence_id": first[at] + key - keys[at], "offset": offsets[at]}
            yield pa.RecordBatch.from_pydict(columns)

    types = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "rank")
    return ranked.mapInArrow(assign, f"{types}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, docs) from pieces packed with their ids: the token ids in place, and what lies where.

    A sequence has at most ``capacity`` pieces, so its group is bounded.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    rows = packed.groupBy("sequence_id").agg(inside.alias("inside"))
    return rows.select(
        "sequence_id",
        F.aggregate("inside", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.aggregate("inside", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"),
        F.transform("inside", lambda x: F.struct(x["offset"], x["length"], x["doc_id"], x["piece"])).alias("docs"),
    )
