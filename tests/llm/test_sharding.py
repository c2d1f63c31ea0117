import random

from corpus import awkward, docs, texts
from pyspark.sql import functions as F

from pulsefeed.llm import sharding


def check(rows, out, shards, slack):
    got = [r.asDict() for r in out.select("row.doc_id", "row.text", "size", "shard", "slot").collect()]
    assert len(got) == len(rows)
    for g in got:
        assert g["size"] == len((g["text"] or "").encode()) + 8 and 0 <= g["shard"] < shards
    by = {}
    for g in got:
        by.setdefault(g["shard"], []).append(g)
    for members in by.values():
        assert sorted(g["slot"] for g in members) == list(range(len(members)))
    total, largest = sum(g["size"] for g in got), max(g["size"] for g in got)
    for k in range(shards):
        assert abs(sum(g["size"] for g in by.get(k, [])) - total / shards) <= slack * total / shards + 2 * largest
    return got


def test_even_bytes(spark):
    rows = [(i, t) for i, t in enumerate(texts(1500, seed=2))]
    check(rows, sharding.assign_shards(docs(spark, rows), shards=24), 24, 0.01)


def test_hot_text_is_cut_by_id_only_where_needed(spark):
    rows = [(i, "the same text again and again") for i in range(600)] + [(1000 + i, t) for i, t in enumerate(texts(300, seed=4))]
    random.Random(1).shuffle(rows)
    got = check(rows, sharding.assign_shards(docs(spark, rows), shards=8), 8, 0.05)
    where = {}
    for g in got:
        where.setdefault(g["text"], set()).add(g["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 8 and len(where["the same text again and again"]) > 2


def test_splitters_against_counting(spark):
    rng = random.Random(3)
    stats = [(rng.choice([5, rng.getrandbits(63), -rng.getrandbits(63)]), rng.randrange(1000), rng.randint(8, 90)) for _ in range(800)]
    bounds, _ = sharding.splitters(spark.createDataFrame(stats, "h long, id long, size long"), 10, 0.001)
    total = sum(s[2] for s in stats)
    assert bounds == sorted(bounds)
    for k, b in enumerate(bounds, 1):
        below = sum(s[2] for s in stats if (s[0], s[1]) < b)
        assert abs(below - total * k / 10) <= 0.001 * total / 10 + 5 * 90


def test_a_third_of_the_rows_alike(spark):
    """Rows equal in text and id, and rows of null ids, are cut as well; no task gets them all."""
    for same in (7, None):
        rows = [(same, "the same text again and again")] * 900 + [(1000 + i, t) for i, t in enumerate(texts(600, seed=5))]
        random.Random(2).shuffle(rows)
        out = sharding.assign_shards(docs(spark, rows).repartition(6), shards=24)
        got = check(rows, out, 24, 0.05)
        assert len({g["shard"] for g in got}) == 24


def test_repeated_rows_alone_are_told_from_large_ones(spark):
    make = lambda stats: spark.createDataFrame(stats, "h long, id long, size long")
    assert sharding.splitters(make([(i, 0, 5000 if i == 3 else 50) for i in range(100)]), 8)[1]
    assert not sharding.splitters(make([(3, 0, 50)] * 100 + [(i, 0, 50) for i in range(100)]), 8)[1]


def test_awkward_rows_and_clashing_names(spark):
    rows = awkward()
    out = sharding.shard(docs(spark, rows), shards=3)
    assert out.count() == len(rows) and out.columns.count("shard") == 1 and "slot" in out.columns
    assert out.agg(F.count("shard")).first()[0] == len(rows)
    assert sharding.shard(docs(spark, []), shards=3).collect() == []
