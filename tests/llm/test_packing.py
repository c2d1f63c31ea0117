import random
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus import awkward, docs, texts
from tokenizers import Tokenizer

from pulsefeed.llm import packing
from pulsefeed.llm.queries import tokenizer_path


def plain_ids(text):
    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [0]


def used(plan):
    out = Counter()
    for times, lengths in plan:
        for x in lengths:
            out[x] += times
    return out


def fewest(lengths, capacity):
    """The least number of sequences, by trying all ways (small cases)."""
    best = len(lengths)

    def go(i, rest):
        nonlocal best
        if len(rest) >= best:
            return
        if i == len(lengths):
            best = len(rest)
            return
        for k in range(len(rest)):
            if rest[k] >= lengths[i]:
                rest[k] -= lengths[i]
                go(i + 1, rest)
                rest[k] += lengths[i]
        rest.append(capacity - lengths[i])
        go(i + 1, rest)
        rest.pop()

    go(0, [])
    return best


def test_cut():
    assert packing.cut(1, 8) == [1] and packing.cut(8, 8) == [8] and packing.cut(9, 8) == [1, 8] and packing.cut(24, 8) == [8, 8, 8]
    for n in range(1, 60):
        assert sum(packing.cut(n, 7)) == n and max(packing.cut(n, 7)) <= 7 and set(packing.cut(n, 7)[1:]) <= {7}


@pytest.mark.parametrize("seed", range(60))
def test_plan_uses_every_piece_once_and_is_near_the_least(seed):
    rng = random.Random(seed)
    capacity = rng.randint(1, 24)
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
    plan = packing.plan_packing(Counter(lengths), capacity)
    assert used(plan) == Counter(lengths) and all(sum(x) <= capacity for _, x in plan)
    assert sum(n for n, _ in plan) <= fewest(sorted(lengths, reverse=True), capacity) + 1


def test_exact_sums_against_all_combinations():
    rng = random.Random(3)
    for _ in range(60):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        index = packing.ExactSums(counts, 20)
        stock = list(Counter(counts).elements())
        for s in range(1, 21):
            pairs = any(stock[i] + stock[j] == s for i in range(len(stock)) for j in range(i))
            triples = any(stock[i] + stock[j] + stock[k] == s for i in range(len(stock)) for j in range(i) for k in range(j))
            pair, triple = index.pair(s), index.triple(s)
            assert bool(pair) == pairs and bool(triple) == triples
            for got in filter(None, (pair, triple)):
                assert sum(got) == s and all(n <= counts[x] for x, n in Counter(got).items())


def test_many_pieces_come_near_the_bound():
    rng = random.Random(1)
    counts = Counter(min(2047, int(rng.lognormvariate(5.5, 1.4)) + 1) for _ in range(100_000))
    plan = packing.plan_packing(dict(counts))
    assert used(plan) == counts
    total = sum(k * n for k, n in counts.items())
    assert sum(n for n, _ in plan) <= -(-total // 2048) * 1.001 + 1
    # A hundred times the pieces need hardly more of a plan.
    large = packing.plan_packing({k: 100 * n for k, n in counts.items()})
    assert len(large) < 4 * 2048


def check(rows, got, capacity):
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.start == 0 and r.piece == 0), []).append(r)
    want = Counter()
    for doc_id, text, *_ in rows:
        ids, start = plain_ids(text), 0
        for k, n in enumerate(packing.cut(len(ids), capacity)):
            crc = zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
            want[(doc_id, k, start, n, crc)] += 1
            start += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


@pytest.mark.parametrize("capacity", [16, 2048])
def test_operator(spark, capacity):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(texts(40))] + [(500, "a<|endoftext|> b <|endoftext|>")]
    got = packing.pack(docs(spark, rows).repartition(5), tokenizer_path(), capacity).collect()
    sequences = check(rows, got, capacity)
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // capacity) * 1.02 + 1


def test_a_third_of_the_rows_alike(spark):
    rows = [(7, "the same text again")] * 200 + [(i, t) for i, t in enumerate(texts(400, seed=2))]
    got = packing.pack(docs(spark, rows).repartition(7), tokenizer_path(), 64).collect()
    check(rows, got, 64)


def test_ids_of_the_sequences(spark):
    rows = [(i, t) for i, t in enumerate(texts(30, seed=4))]
    packed = packing.pack(docs(spark, rows), tokenizer_path(), 128, with_ids=True)
    found = {}
    for s in packing.sequences(packed).collect():
        ids = np.frombuffer(s.ids, "<u4")
        assert len(ids) == s.n_tokens <= 128
        for d in s.docs:
            found.setdefault(d.doc_id, {})[d.piece] = ids[d.offset : d.offset + d.length].tolist()
    assert {i: sum((p[k] for k in sorted(p)), []) for i, p in found.items()} == {i: plain_ids(t) for i, t in rows}


def test_empty_table(spark):
    assert packing.pack(docs(spark, []), tokenizer_path()).count() == 0
