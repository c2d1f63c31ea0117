"""Phrase collocations of each language, counted with weighted acyclic automata.

A level of phrase lengths is counted by one pass over the texts. A task counts
the n-grams of its texts in shards, sorts each shard and builds a count
transducer of it (``transducer.py``). The shards are written; ranges of their sort
order are chosen from evenly spaced n-grams, the transducers are cut at those
bounds, dealt to the ranges, and united there with their weights summed. So a
frequent n-gram, word or language costs one entry per shard, and no range holds
more n-grams than planned, whatever they begin with.

Levels are words, pairs, and all longer lengths together. A phrase is only as
frequent as its parts, so a pass skips n-grams with a rare word or pair. What is
frequent reaches the tasks as a bitmap of hashes, of ``FILTER_BITS`` bits at any
corpus size. A false hit means a count more, never a wrong result; a larger
vocabulary than the bitmap separates means a larger exchange.

Parts are looked up by composition. Every range of phrases sends automata of the
parts it asks for to the ranges that count them, where they are composed with the
count transducers, and the weighted results come back. A part is asked once per
range, however many phrases share it. Scores are exact integers of any size.

Null texts are empty, a null language is ``und``. Repeated rows count as often as
they stand there; ids and other columns, of any name, are not read. Long texts are
cut between pieces only. Ties are ordered by count and phrase. An empty table, or
one without a frequent phrase, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsefeed.llm.common import keep, text_or_empty
from pulsefeed.llm.transducer import Grams, Transducer, places, union

MAX_WORDS = 5
MIN_COUNT = 100
SCALE = 1000
COVERED_PERCENT = 100
TOP = 2000
NO_LANG = "und"

FILTER_BITS = 1 << 24
SLICE_BYTES = 8 << 20
SHARD_GRAMS = 1 << 20
PIECE_GRAMS = 1 << 13
RANGE_GRAMS = 1 << 20
# n-grams that a shard offers as bounds, and how many of all are read: they only steer how even the ranges are.
SAMPLES_PER_SHARD = 16
MAX_SAMPLES = 1 << 20
_SALTS = 16
_BLOCK_BITS = 32_768
_SEPARATOR = 10

# A-Z lowered, the characters between pieces as line feed, a tab as a space.
_TABLE = bytearray(c + 32 if 65 <= c <= 90 else c for c in range(256))
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = _SEPARATOR
_TABLE[9] = 32
_TABLE = bytes(_TABLE)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """The texts as bytes of pieces between line feeds, in runs that end with a piece and pass ``limit`` only within one."""
    at = 0
    while at < len(texts):
        size = np.cumsum(pc.binary_length(texts.slice(at)).to_numpy(zero_copy_only=False))
        n = max(1, int(np.searchsorted(size, limit, "right")))
        raw = b"\n".join(texts.slice(at, n).to_pylist()).translate(_TABLE)
        begin = 0
        while begin < len(raw):
            end = len(raw)
            if end - begin > 2 * limit:
                end = raw.rfind(b"\n", begin, begin + limit) + 1 or raw.find(b"\n", begin + limit) + 1 or len(raw)
            yield raw[begin:end]
            begin = end
        at += n


def tokens(raw: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(sorted words, number of each word of the text, number of its piece)."""
    a = np.frombuffer(raw, np.uint8)
    inside = (a != 32) & (a != _SEPARATOR)
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.cumsum(np.append(0, ends - starts))
    flat = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(a[inside])])
    coded = flat.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), number[coded.indices.to_numpy()], np.searchsorted(np.flatnonzero(a == _SEPARATOR), starts)


def word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    salt = lang.encode() + b"\n"
    return np.fromiter((xxhash.xxh64_intdigest(salt + w) for w in words.to_pylist()), np.uint64, len(words))


def gram_hashes(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of the hashes of an n-gram's words, in order."""
    out = hashes[0]
    for h in hashes[1:]:
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return out


def bits_of(hashes: np.ndarray, filter_bits: int) -> np.ndarray:
    return (hashes % np.uint64(filter_bits)).astype(np.int64)


def _has(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 3] >> (bits & 7)).astype(np.uint8) & 1 == 1


def slice_grams(raw: bytes, lang: str, low: int, high: int, filters: list[np.ndarray]) -> list[Grams]:
    """Counts of the n-grams of ``low`` to ``high`` words in the slice whose words (and pairs) pass the filters."""
    words, ids, piece = tokens(raw)
    n, size = len(words), len(ids)
    if low == 1 == high:
        return [Grams(words, np.arange(n)[:, None], np.bincount(ids, minlength=n))] if n else []
    hashes = word_hashes(lang, words)
    fine = _has(filters[0], bits_of(hashes, len(filters[0]) * 8))[ids]
    # ``at``: where n-grams of k words begin; ``group``: which of the distinct ones stands there.
    at = np.flatnonzero(fine[:-1] & fine[1:] & (piece[:-1] == piece[1:])) if size > 1 else np.zeros(0, np.int64)
    if low > 2:
        pair = gram_hashes([hashes[ids[at]], hashes[ids[at + 1]]])
        at = at[_has(filters[1], bits_of(pair, len(filters[1]) * 8))]
    pairs = np.zeros(size + 1, bool)
    pairs[at] = True
    group = ids[at]
    out = []
    for k in range(2, high + 1):
        if k > 2:
            goes_on = pairs[at + k - 2]
            at, group = at[goes_on], group[goes_on]
        _, first, group, counts = np.unique(group * n + ids[at + k - 1], return_index=True, return_inverse=True, return_counts=True)
        if k >= low and len(first):
            keys = np.full((len(first), high), -1)
            keys[:, :k] = ids[at[first][:, None] + np.arange(k)]
            out.append(Grams(words, keys, counts))
    return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SHARDS = pa.schema([("lang", pa.string()), ("data", pa.binary()), ("size", pa.int64()), ("total", pa.int64()), ("samples", pa.list_(pa.binary()))])
_SHARDS_DDL = "lang string, data binary, size long, total long, samples array<binary>"


def shards(docs: DataFrame, low: int, high: int, filters: list, shard_grams: int = SHARD_GRAMS) -> DataFrame:
    """Count transducers of the shards: (lang, data, size, total of the counts, evenly spaced n-grams)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [np.frombuffer(f.value, np.uint8) for f in filters]
        open_: dict[str, list[Grams]] = {}

        def closed(lang: str) -> pa.RecordBatch:
            grams = union(open_.pop(lang), high)
            every = max(1, len(grams) // SAMPLES_PER_SHARD)
            samples = [b" ".join(g) for g in grams.take(np.arange(every // 2, len(grams), every)).texts()]
            return _batch([(lang, Transducer.build(grams).to_bytes(), len(grams), int(grams.counts.sum()), samples)], _SHARDS)

        for batch in batches:
            for lang in pc.unique(batch["lang"]).to_pylist():
                texts = batch["text"].filter(pc.equal(batch["lang"], lang)).cast(pa.large_binary())
                for raw in slices(texts):
                    open_.setdefault(lang, []).extend(slice_grams(raw, lang, low, high, bitmaps))
                    if sum(map(len, open_[lang])) >= shard_grams:
                        yield closed(lang)
            # Small languages wait for company, as long as all that waits is bounded.
            if sum(len(g) for gs in open_.values() for g in gs) >= 4 * shard_grams:
                yield from [closed(lang) for lang in list(open_)]
        yield from [closed(lang) for lang, gs in list(open_.items()) if gs]

    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), text_or_empty("text").alias("text"))
    return keep(rows.mapInArrow(count, _SHARDS_DDL), "ngram-shards")


def range_bounds(made: DataFrame, depth: int, range_grams: int = RANGE_GRAMS) -> dict[str, Grams]:
    """The n-grams that begin the second and later ranges of each language that needs more than one."""
    sizes = made.groupBy("lang").agg(F.sum("size").alias("size")).filter(F.col("size") > range_grams)
    sizes = {r.lang: r.size for r in sizes.limit(MAX_SAMPLES).collect()}
    if not sizes:
        return {}
    offered = made.select("lang", "samples").filter(F.col("lang").isin(list(sizes))).orderBy(F.xxhash64("lang", "samples"))
    found: dict[str, list[tuple[bytes, ...]]] = {}
    for r in offered.limit(MAX_SAMPLES // SAMPLES_PER_SHARD).collect():
        found.setdefault(r.lang, []).extend(tuple(bytes(s).split(b" ")) for s in r.samples)
    bounds = {}
    for lang, grams in found.items():
        grams, n = sorted(grams), -(-sizes[lang] // range_grams)
        chosen = sorted({grams[len(grams) * k // n] for k in range(1, n)})
        bounds[lang] = Grams.of([list(g) for g in chosen], [1] * len(chosen), depth)
    return bounds


def cut(grams: Grams, bounds: Grams | None, piece_grams: int = PIECE_GRAMS) -> Iterator[tuple[int, Grams]]:
    """(range, n-grams) in pieces of bounded size."""
    place = places(grams, bounds) if bounds is not None else np.zeros(len(grams), np.int64)
    edges = np.flatnonzero(np.diff(place, prepend=-1, append=-2))
    for a, b in zip(edges, edges[1:]):
        for at in range(a, b, piece_grams):
            yield int(place[a]), grams.take(np.arange(at, min(at + piece_grams, b)))


_PIECES = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("data", pa.binary())])
_PIECES_DDL = "lang string, range int, data binary"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}


def united(made: DataFrame, bounds: dict[str, Grams], depth: int, min_count: int) -> DataFrame:
    """(lang, range, data): the transducers of all shards, united by range, of the n-grams counted at least ``min_count`` times."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            grams = Transducer.from_bytes(row["data"]).grams()
            for place, part in cut(grams, bounds.get(row["lang"])):
                yield _batch([(row["lang"], place, Transducer.build(part).to_bytes())], _PIECES)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, place), rows in groupby(_rows(batches), lambda r: (r["lang"], r["range"])):
            parts, waiting, base = [], 0, 0
            for row in rows:
                parts.append(Transducer.from_bytes(row["data"]).grams())
                waiting += len(parts[-1])
                # Summing when as much waits as is united keeps both memory and work in proportion.
                if waiting > SHARD_GRAMS + base:
                    parts = [union(parts, depth)]
                    base, waiting = len(parts[0]), 0
            grams = union(parts, depth)
            grams = grams.take(grams.counts >= min_count)
            if len(grams):
                yield _batch([(lang, place, Transducer.build(grams).to_bytes())], _PIECES)

    dealt = made.select("lang", "data").mapInArrow(pieces, _PIECES_DDL).repartition("lang", "range")
    return keep(dealt.sortWithinPartitions("lang", "range").mapInArrow(fold, _PIECES_DDL), "ngram-counts")


def bitmap(counted: DataFrame, filter_bits: int = FILTER_BITS) -> bytes:
    """The hashes of the counted n-grams as ``filter_bits`` bits, gathered by block: that is all the driver gets."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            grams = Transducer.from_bytes(row["data"]).grams()
            hashes = word_hashes(row["lang"], grams.words)
            lengths = (grams.keys >= 0).sum(axis=1)
            for k in np.unique(lengths):
                keys = grams.keys[lengths == k]
                bits = np.unique(bits_of(gram_hashes([hashes[keys[:, j]] for j in range(k)]), filter_bits))
                yield pa.RecordBatch.from_pydict({"bit": bits})

    marked = counted.select("lang", "data").mapInArrow(mark, "bit long")
    block = F.floor(F.col("bit") / _BLOCK_BITS)
    blocks = marked.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(F.col("bit") % _BLOCK_BITS).alias("bits"))
    out = bytearray(-(-filter_bits // _BLOCK_BITS) * _BLOCK_BITS // 8)
    for r in blocks.collect():
        out[r.block * _BLOCK_BITS // 8 : (r.block + 1) * _BLOCK_BITS // 8] = r.bits
    return bytes(out[: filter_bits // 8])


def _levels(max_words: int) -> list[tuple[int, int]]:
    return [(1, 1), (2, 2), (3, max_words)][: min(3, max_words)]


def _parts(grams: Grams) -> Iterator[tuple[int, Grams, Grams]]:
    """(k, first k words, rest) of the n-grams of more than k words; ``counts`` are their row numbers."""
    lengths = (grams.keys >= 0).sum(axis=1)
    for k in range(1, grams.keys.shape[1]):
        rows = np.flatnonzero(lengths > k)
        head, tail = grams.keys[rows].copy(), np.full((len(rows), grams.keys.shape[1]), -1)
        head[:, k:] = -1
        tail[:, :-k] = grams.keys[rows][:, k:]
        yield k, Grams(grams.words, head, rows), Grams(grams.words, tail, rows)


_ASKS = pa.schema([("level", pa.int32()), ("lang", pa.string()), ("range", pa.int32()), ("kind", pa.int32()), ("home_level", pa.int32()), ("home_range", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
_ASKS_DDL = "level int, lang string, range int, kind int, home_level int, home_range int, n long, data binary"
_COUNTS, _TOTAL, _ASK = 0, 1, 2
_SCORED_DDL = "lang string, phrase string, a long, l long, r long, n long, score long, covers array<string>"
_SCORED = pa.schema([("lang", pa.string()), ("phrase", pa.string())] + [(c, pa.int64()) for c in ("a", "l", "r", "n", "score")] + [("covers", pa.list_(pa.string()))])


def scored(counted: list[DataFrame], bounds: list[dict[str, Grams]], totals: DataFrame, levels: list[tuple[int, int]], scale: int = SCALE, percent: int = COVERED_PERCENT) -> DataFrame:
    """Every frequent phrase with its lowest-scoring cut, and the parts it covers."""
    none = [F.lit(0).alias("home_level"), F.lit(0).alias("home_range")]
    tables = None
    for k, df in enumerate(counted):
        rows = df.select(F.lit(k).alias("level"), "lang", "range", F.lit(_COUNTS).alias("kind"), *none, F.lit(0).cast("long").alias("n"), "data")
        tables = rows if tables is None else tables.unionByName(rows)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            grams = Transducer.from_bytes(row["data"]).grams()
            parts = union([g.trimmed() for _, head, tail in _parts(grams) for g in (head, tail)], grams.keys.shape[1])
            lengths = (parts.keys >= 0).sum(axis=1)
            for level, (low, high) in enumerate(levels):
                own = parts.take((lengths >= low) & (lengths <= high))
                own = _deep(Grams(own.words, own.keys, np.ones(len(own), np.int64)), high)
                for place, piece in cut(own, bounds[level].get(row["lang"])):
                    yield _batch([(level, row["lang"], place, _ASK, row["level"], row["range"], 0, Transducer.build(piece).to_bytes())], _ASKS)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Asked parts composed with the counts of their range; the counts come first."""
        counts, of = None, None
        for row in _rows(batches):
            key = (row["level"], row["lang"], row["range"])
            if row["kind"] == _COUNTS:
                counts, of = Transducer.from_bytes(row["data"]), key
                continue
            asked = Transducer.from_bytes(row["data"]).grams()
            if of == key:
                answered = Transducer.build(Grams(asked.words, asked.keys, counts.compose(asked)))
                yield _batch([(row["home_level"], row["lang"], row["home_range"], _ASK, 0, 0, 0, answered.to_bytes())], _ASKS)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lang, _), rows in groupby(_rows(batches), lambda r: (r["level"], r["lang"], r["range"])):
            grams, n, answers = None, 0, []
            for row in rows:
                if row["kind"] == _TOTAL:
                    n = row["n"]
                elif row["kind"] == _COUNTS:
                    grams = Transducer.from_bytes(row["data"]).grams()
                else:
                    answers.append(_deep(Transducer.from_bytes(row["data"]).grams(), grams.keys.shape[1]))
            known = Transducer.build(union(answers, grams.keys.shape[1]))
            a = grams.counts.astype(object)
            best: list[tuple[int, int, int] | None] = [None] * len(grams)
            covers: list[list[str]] = [[] for _ in range(len(grams))]
            lengths = (grams.keys >= 0).sum(axis=1)
            for k, head, tail in _parts(grams):
                left, right = known.compose(head), known.compose(tail)
                value = scale * a[head.counts] * n // (left.astype(object) * right.astype(object))
                for i, x, p, q in zip(head.counts.tolist(), value, left.tolist(), right.tolist()):
                    if best[i] is None or x < best[i][0]:
                        best[i] = (x, p, q)
                for part, f, chosen in ((head, left, lengths[head.counts] == k + 1), (tail, right, np.full(len(tail), k == 1))):
                    part_length = (part.keys >= 0).sum(axis=1)
                    hit = np.flatnonzero(chosen & (part_length > 1) & (100 * a[part.counts] >= percent * f.astype(object)).astype(bool))
                    for i, text in zip(part.counts[hit].tolist(), part.take(hit).texts()):
                        covers[i].append(b" ".join(text).decode())
            phrases = [b" ".join(g).decode() for g in grams.texts()]
            out = [(lang, p, c, x[1], x[2], n, x[0], v) for p, c, x, v in zip(phrases, grams.counts.tolist(), best, covers)]
            for at in range(0, len(out), PIECE_GRAMS):
                yield _batch(out[at : at + PIECE_GRAMS], _SCORED)

    place = ["level", "lang", "range"]
    phrases = tables.filter("level > 0")
    answers = tables.unionByName(phrases.mapInArrow(ask, _ASKS_DDL)).repartition(*place)
    answers = answers.sortWithinPartitions(*place, "kind").mapInArrow(answer, _ASKS_DDL)
    sizes = phrases.select(*place).join(totals, "lang").select(*place, F.lit(_TOTAL).alias("kind"), *none, F.col("total").alias("n"), F.lit(None).cast("binary").alias("data"))
    home = phrases.unionByName(answers).unionByName(sizes).repartition(*place)
    return keep(home.sortWithinPartitions(*place, "kind").mapInArrow(score, _SCORED_DDL), "phrases-scored")


def _deep(grams: Grams, depth: int) -> Grams:
    """The same n-grams with room for ``depth`` words."""
    have = grams.keys.shape[1]
    if have >= depth:
        return Grams(grams.words, grams.keys[:, :depth], grams.counts)
    return Grams(grams.words, np.pad(grams.keys, ((0, 0), (0, depth - have)), constant_values=-1), grams.counts)


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, scale: int = SCALE, percent: int = COVERED_PERCENT, filter_bits: int = FILTER_BITS, shard_grams: int = SHARD_GRAMS, range_grams: int = RANGE_GRAMS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    spark: SparkSession = docs.sparkSession
    levels = _levels(max_words)
    filters, counted, bounds, totals = [], [], [], None
    for low, high in levels:
        made = shards(docs, low, high, filters, shard_grams)
        totals = totals or keep(made.groupBy("lang").agg(F.sum("total").alias("total")), "ngram-totals")
        bounds.append(range_bounds(made, high, range_grams))
        counted.append(united(made, bounds[-1], high, min_count))
        if len(counted) < len(levels):
            filters.append(spark.sparkContext.broadcast(bitmap(counted[-1], filter_bits)))
    found = scored(counted, bounds, totals, levels, scale, percent)
    covered = found.select(F.col("lang").alias("c_lang"), F.explode("covers").alias("c_phrase")).distinct()
    found = found.join(covered, (F.col("lang") == F.col("c_lang")) & (F.col("phrase") == F.col("c_phrase")), "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First within salted parts of a language, then among their firsts.
    salted = Window.partitionBy("lang", "salt").orderBy(*order)
    firsts = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
