"""Benchmark decontamination with a generalised suffix automaton.

The items' words go into one automaton for all items of a block; a document's
words are streamed through it and the longest match that ends at each word is
tracked. Wherever it is at least a window long, the words it covers are hit.
Items shorter than a window count as a whole. Spans that are hit are removed, and
a document that they cover beyond a limit goes.

Tasks cut the items into blocks of at most ``BLOCK_WORDS`` words (longer items in
pieces that overlap by a window less one word) and build an automaton of each. A
benchmark of one block is one pass inside the caller's plan. For a larger one the
documents are written with a row key, and each block is a pass of its own over
that table: only the rows it hits are written, and its automaton is dropped
before the next is sent, so a task holds one at a time. The passes, and with them
the cost, grow with the number of blocks. Null and empty
texts have no words, hit nothing and stay. Items without words have no window.
Repeated items are items of their own. Repeated documents are each judged. Other
columns of any name pass through.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.common import held, keep, plain_words, shared_path

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_WORDS = 200_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.length, self.link = [0], [-1]
        self.next: list[dict[int, int]] = [{}]
        self.items: dict[int, set] = {}
        self.shorts: dict[int, list[tuple[int, object]]] = {}
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items if words]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.least = min((min(len(words), window) for _, words in coded), default=window)
        for name, words in coded:
            state = length = 0
            for w in words:
                state, length = self._step(state, length, w)
                if length >= window:
                    state, length = self._suffix(state, window), window
                    self.items.setdefault(state, set()).add(name)
            if len(words) < window:
                self.shorts.setdefault(state, []).append((len(words), name))

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = self._state(length[last] + 1, {})
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(0)
        self.next.append(moves)
        return len(self.length) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        made = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[made], self.link[q] = self.link[q], made
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = made
            p = self.link[p]
        return made

    def _step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """The longest match after one more word."""
        while w not in self.next[state]:
            state = self.link[state]
            if state == -1:
                return 0, 0
            length = self.length[state]
        return self.next[state][w], length + 1

    def _suffix(self, state: int, length: int) -> int:
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def match(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words are hit, and by windows of which items.

        Only runs of known words that could hold a window are streamed.
        """
        hit = np.zeros(len(words) + 1, np.int32)
        found: set = set()
        codes = np.fromiter(map(self.ids.get, words, [-1] * len(words)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (codes >= 0).view(np.int8), [0]])))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < self.least:
                continue
            state = length = 0
            for at, w in enumerate(codes[start:end].tolist(), start):
                state, length = self._step(state, length, w)
                if length >= self.window:
                    # The match goes on as a window: a word leaves as many links as it takes, so all walks are one pass.
                    length = self.window
                    state = self._suffix(state, length)
                    hit[at + 1 - length] += 1
                    hit[at + 1] -= 1
                    found |= self.items[state]
                if self.shorts:
                    for size, name in self._ends(state, length):
                        hit[at + 1 - size] += 1
                        hit[at + 1] -= 1
                        found.add(name)
        return np.cumsum(hit[:-1]) > 0, found

    def _ends(self, state: int, length: int) -> Iterator[tuple[int, object]]:
        """Whole short items that end here: those of the state and of its shorter suffixes."""
        while state > 0:
            yield from (x for x in self.shorts.get(state, ()) if x[0] <= length)
            state = self.link[state]


class Packed:
    """A pickled automaton that becomes one where a worker unpickles it; the driver only passes the bytes on."""

    def __init__(self, data: bytes):
        self.data = data

    def __reduce__(self) -> tuple:
        return pickle.loads, (self.data,)


def pieces(words: list[bytes], window: int, size: int) -> Iterator[list[bytes]]:
    """Runs of at most ``size`` words that hold every window of the words, each window once."""
    if words:
        yield words[:size]
    step = size - window + 1
    for at in range(step, len(words) - window + 1, step):
        yield words[at : at + size]


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(block, n_words, data): pickled automata of at most ``block_words`` words (two windows at least), as a table.

    Tasks pack the items they read; the driver sees the size of every pack and
    puts small ones together, and each automaton is built where its packs meet.
    """
    size = max(block_words, 2 * window)
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, total, ids, texts = 0, 0, 0, [], []

        def packed() -> pa.RecordBatch:
            columns = [pa.array([x]) for x in (part, number, total)] + [pa.array([ids], held_ids), pa.array([texts], pa.list_(pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["part", "number", "n_words", "ids", "texts"])

        for batch in batches:
            held_ids = pa.list_(batch.schema.field("item_id").type)
            for part, name, text in zip(*(batch[c].to_pylist() for c in ("part", "item_id", "text"))):
                for piece in pieces(plain_words(text), window, size):
                    if total + len(piece) > size:
                        yield packed()
                        number, total, ids, texts = number + 1, 0, [], []
                    ids.append(name)
                    texts.append(b" ".join(piece))
                    total += len(piece)
        if ids:
            yield packed()

    items = benchmark.select(F.spark_partition_id().cast("long").alias("part"), "item_id", "text")
    packs = keep(items.mapInArrow(pack, f"part long, number long, n_words long, ids array<{kind}>, texts array<binary>"), "item-packs")
    block, total, places = 0, 0, []
    for row in sorted(packs.select("n_words", "part", "number").collect(), reverse=True):
        if total + row.n_words > size:
            block, total = block + 1, 0
        places.append((row.part, row.number, block))
        total += row.n_words

    def build(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["number"]))
        items = [(name, text.split()) for r in rows for name, text in zip(r["ids"], r["texts"])]
        data = pickle.dumps(Automaton(items, window), pickle.HIGHEST_PROTOCOL)
        return pa.table({"block": [rows[0]["block"]], "n_words": [sum(r["n_words"] for r in rows)], "data": pa.array([data], pa.binary())})

    placed = packs.join(F.broadcast(packs.sparkSession.createDataFrame(places, "part long, number long, block long")), ["part", "number"])
    return keep(placed.groupBy("block").applyInArrow(build, "block long, n_words long, data binary"), "automata")


def spans_hit(hit: np.ndarray) -> list[list[int]]:
    """[first, last + 1] word positions of the runs that are hit."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


def _matcher(shared) -> Callable[[Column], Column]:
    @F.pandas_udf("n_words long, spans array<array<int>>, items array<string>")
    def match(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            words = plain_words(text)
            hit, found = shared.value.match(words)
            out.append((len(words), spans_hit(hit), sorted(str(x) for x in found)))
        return pd.DataFrame(out, columns=["n_words", "spans", "items"])

    # A deterministic function would run once more for every filter on its result.
    return match.asNondeterministic()


def matches(rows: DataFrame, text: Column, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``rows`` with ``found``: n_words, the spans hit and the ids (as text) of the items found, over all blocks."""
    spark = rows.sparkSession
    automata = blocks(benchmark, window, block_words)
    numbers = sorted(r.block for r in automata.select("block").collect())

    def shared(block: int):
        return spark.sparkContext.broadcast(Packed(automata.filter(F.col("block") == block).first().data))

    if len(numbers) < 2:
        only = shared(numbers[0]) if numbers else spark.sparkContext.broadcast(Automaton([], window))
        return rows.withColumn("found", _matcher(only)(text))

    # Ids may be null or repeated, so rows get a key of their own; written, it is the same for every pass.
    sent = shared(numbers[0])
    kept = keep(rows.withColumn("_key", F.monotonically_increasing_id()).withColumn("found", _matcher(sent)(text)), "found")
    sent.destroy()
    base, paths = shared_path(spark, "hits"), []
    for block in numbers[1:]:
        sent = shared(block)
        got = kept.select("_key", _matcher(sent)(text).alias("got")).filter(F.size("got.spans") > 0)
        paths.append(f"{base}/{block}")
        got.select("_key", "got.spans", "got.items").write.parquet(paths[-1])
        sent.destroy()
    hits = spark.read.schema("_key long, spans array<array<int>>, items array<string>").parquet(*paths)
    more = hits.groupBy("_key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    both = kept.join(more.select("_key", F.struct("spans", "items").alias("_more")), "_key", "left")
    joined = lambda c: F.when(F.col("_more").isNull(), F.col("found")[c]).otherwise(F.concat(F.col("found")[c], F.col("_more")[c])).alias(c)
    found = F.struct(F.col("found.n_words").alias("n_words"), joined("spans"), joined("items"))
    return both.withColumn("found", found).drop("_key", "_more")


def _hit_words(spans: Column) -> Column:
    """Words under the union of spans, which may overlap between blocks."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    add = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s[1] - F.greatest(s[0], a["end"]))).alias("n"), F.greatest(a["end"], s[1]).alias("end")
    )
    return F.aggregate(F.array_sort(spans), zero, add)["n"].cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, items) for every document."""
    found = matches(docs.select("doc_id", "text"), F.col("text"), benchmark, window, block_words)
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        _hit_words(F.col("found.spans")).alias("n_hit"),
        F.array_sort(F.array_distinct("found.items")).alias("items"),
    )


def without_spans(text: str, spans: list) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw.translate(_LOWER))]
    out, at = [], 0
    for first, end in sorted((int(a), int(b)) for a, b in spans):
        out.append(raw[at : max(at, places[first][0])])
        at = max(at, places[end - 1][1])
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """The documents without the spans hit, and without those covered beyond the limit; ``n_chars`` follows the text."""
    found = matches(held(docs), F.col("row.text"), benchmark, window)
    found = found.select("row", "found.n_words", "found.spans", _hit_words(F.col("found.spans")).alias("n_hit"))
    found = found.filter((F.col("n_hit") <= F.col("n_words") * F.lit(max_coverage)))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else without_spans(t, s) for t, s in zip(texts, spans)])

    # Only texts to cut go to Python once more; the others stay as they are.
    dirty = F.when(F.col("n_hit") > 0, F.col("row.text"))
    found = found.withColumn("cut", cut(dirty, F.when(F.col("n_hit") > 0, F.col("spans"))))
    text = F.when(F.col("n_hit") > 0, F.col("cut")).otherwise(F.col("row.text"))
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("n_hit") > 0, F.char_length("cut").cast(kind)).otherwise(F.col("row.n_chars")))
    return found.select(row.alias("row")).select("row.*")

