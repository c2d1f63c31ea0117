import pytest
from corpus import awkward, docs, texts

from pulsefeed.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        level = left / sum(w[s] for s in free) if free else 0
        above = {s for s in free if level * w[s] > cap * sizes[s]}
        if not above:
            return {s: cap * sizes[s] if s in full else level * w[s] for s in names}
        full |= above


def corpus_rows():
    return awkward() + [(1000 + i, t, f"src{i % 7}") for i, t in enumerate(texts(700, seed=8))]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_targets_and_taken(spark, limit):
    rows = corpus_rows()
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").split())
    got = mixing.plan_mix(docs(spark, rows), broadcast_limit=limit).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert len(got) == len(rows)
    want, taken = brute_targets(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
    for s in (f"src{i}" for i in range(7)):
        assert taken[s] == pytest.approx(want[s], rel=0.05)


def test_both_joins_and_reruns_agree(spark):
    table = docs(spark, corpus_rows())
    pick = lambda df: sorted((r[0] or -1, r[1]) for r in df.select("row.doc_id", "copies").collect())
    assert pick(mixing.plan_mix(table)) == pick(mixing.plan_mix(table.repartition(9), broadcast_limit=0))


@pytest.mark.parametrize("limit", [100_000, 0])
def test_a_third_of_the_rows_alike(spark, limit):
    """Rows that share an id, or a text without one, are drawn apart: their source comes near its target."""
    rows = [(7, "the same row of several words", "b")] * 900 + [(None, "no id at all here", "b")] * 500
    rows += [(1000 + i, t, f"src{i % 3}") for i, t in enumerate(texts(1500, seed=9))]
    table = docs(spark, rows).repartition(6)
    got = mixing.plan_mix(table, broadcast_limit=limit).select("row.source", "size", "target", "copies").collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
        target[r.source] = r.target
    assert all(taken[s] == pytest.approx(target[s], rel=0.05) for s in target)


def test_mix_emits_copies(spark):
    table = docs(spark, corpus_rows())
    out = mixing.mix(table)
    assert out.columns == table.columns
    want = sum(r[0] for r in mixing.plan_mix(table).select("copies").collect())
    assert out.count() == want


def test_empty(spark):
    assert mixing.mix(docs(spark, [])).collect() == []
