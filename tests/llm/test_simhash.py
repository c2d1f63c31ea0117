import random

import numpy as np
import pytest
import xxhash
from corpus import awkward, docs, texts
from pyspark.sql import functions as F

from pulsefeed.llm import simhash


def brute_fingerprint(text, k=3):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """{position: least position reachable} by search over all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    for t in [r[1] for r in awkward()][:7] + texts(30):
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_whole_long_text():
    long = " ".join(f"w{i % 977}" for i in range(150_000))
    assert simhash.fingerprint(long) == brute_fingerprint(long)


def tilings():
    widths, out = [64], []
    while widths:
        out.append(widths)
        widths = simhash.refined(widths)
    return out


@pytest.mark.parametrize("widths", [t for t in tilings() if len(t) in (1, 2, 3, 4, 5, 7, 8, 13, 16)], ids=len)
def test_no_link_is_lost_in_any_tiling(spark, monkeypatch, widths):
    rng = random.Random(len(widths))
    prints = [rng.getrandbits(64) for _ in range(120)]
    for _ in range(150):  # chains: copies of copies with up to three bits changed
        x = rng.choice(prints)
        for _ in range(rng.randint(0, 3)):
            x ^= 1 << rng.randrange(64)
        prints.append(x)
    prints += [0, 1, 3, (1 << 64) - 1]
    monkeypatch.setattr(simhash, "choose_widths", lambda distinct, n: widths)
    rows = [(i, int(np.uint64(p).view(np.int64))) for i, p in enumerate(prints)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fp long"), 2)
    found = {r.doc_id: r.component_id for r in got.collect()}
    assert [found[i] for i in range(len(prints))] == brute_components(prints, 2)


def test_small_tiles_and_dense_groups(spark):
    base = 0x0123456789ABCDEF
    prints = [base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    rows = [(i, int(np.uint64(p).view(np.int64))) for i, p in enumerate(prints)]
    distinct = spark.createDataFrame([(p,) for _, p in rows], "fp long")
    edges = simhash.links(distinct, len(rows), tile_rows=16)
    assert edges.count() < 40 * len(rows)  # no square of the group
    assert simhash.components(edges).select("root").distinct().count() == 1


def test_tiles_keep_their_size_as_the_table_grows():
    """No number of rows at which tiles suddenly become small or comparisons many."""
    costs = []
    for n in np.geomspace(1_000, 1e11, 400):
        widths = [64]
        while simhash.even_rows(n, widths) > simhash.TARGET_ROWS:
            widths = simhash.refined(widths)
        rows = simhash.even_rows(n, widths)
        assert rows > 200 or n < simhash.TARGET_ROWS * 5
        costs.append(rows * len(simhash._ball(len(widths), 2)))
    # Comparisons per row: a step adds a block, and at most six times the work in all between neighbouring steps.
    assert max(b / a for a, b in zip(costs, costs[1:])) < 1.2


def test_bits_that_go_together_are_split_by_what_is_counted(spark):
    rng = random.Random(4)
    prints = {rng.getrandbits(20) << 44 for _ in range(30_000)}  # all others equal: blocks of them tell nothing apart
    table = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    widths = simhash.choose_widths(table, len(prints), target=64)
    even = [64]
    while simhash.even_rows(len(prints), even) > 64:
        even = simhash.refined(even)
    assert len(widths) > len(even) and sum(widths) == 64


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select((F.col("id") * 7 % 307).alias("u"), ((F.col("id") + 1) * 7 % 307).alias("v"))
    got = simhash.components(edges)
    assert got.count() == 300 and {r.root for r in got.collect()} == {0}


def test_operator_and_keep_one(spark):
    base = texts(40, seed=3, length=(150, 200))
    rows = awkward() + [(100 + i, t) for i, t in enumerate(base)] + [(200 + i, t + " tail") for i, t in enumerate(base)] + [(300, base[0])] * 3
    table = docs(spark, rows)
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.simhash(table).collect()}
    prints = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_components(prints, 2)
    members = {}
    for i, root in enumerate(roots):
        members.setdefault(root, []).append(rows[i][0])
    for i, r in enumerate(rows):
        ids = [x for x in members[roots[i]] if x is not None]
        assert got[(r[0], f"{prints[i]:016x}")] == (min(ids) if ids else None)
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    ids = sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect())
    assert ids == sorted(min([x for x in m if x is not None], default=-1) for m in members.values())


def test_empty(spark):
    assert simhash.simhash(docs(spark, [])).collect() == [] and simhash.keep_one(docs(spark, [])).collect() == []
