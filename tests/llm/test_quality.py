import random

import numpy as np
from corpus import awkward, docs
from pyspark.sql import functions as F

from pulsefeed.llm import quality
from pulsefeed.llm.common import held_out


def walk(trees, row):
    """One row, one node at a time."""
    z = trees.base
    for root in trees.roots:
        at = root
        while trees.feature[at] >= 0:
            at = trees.left[at] if row[trees.feature[at]] <= trees.cut[at] else trees.right[at]
        z += trees.value[at]
    return 1 / (1 + np.exp(-z))


def test_flat_traversal_equals_walking():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.fit_trees(x, y, trees=20)
    assert np.allclose(model.scores(x[:50]), [walk(model, r) for r in x[:50]])
    assert ((model.scores(x) > 0.5) == (y == 1)).mean() > 0.95


def test_any_depth_is_walked_to_the_leaves():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0) ^ (x[:, 2] > 0)).astype(float)
    for depth in (1, 3, 8):
        trees = quality.fit_trees(x, y, trees=6, depth=depth)
        assert np.allclose(trees.scores(x), [walk(trees, r) for r in x])


def test_first_split_is_the_best_of_all_cuts():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, size=(200, 3)).astype(float)
    y = (rng.random(200) < np.where(x[:, 1] > 6, 0.9, 0.2)).astype(float)
    model = quality.fit_trees(x, y, trees=1, depth=1)
    g, h = y.mean() - y, np.full(200, y.mean() * (1 - y.mean()))
    gain = {}
    for f in range(3):
        for c in range(12):
            left = x[:, f] <= c
            if min(left.sum(), (~left).sum()) >= quality.MIN_LEAF:
                gain[f, c] = sum(g[m].sum() ** 2 / (h[m].sum() + quality.L2) for m in (left, ~left))
    f, c = max(gain, key=gain.get)
    assert (model.feature[model.roots[0]], model.cut[model.roots[0]]) == (f, c)


def plain_boosting(x, y, trees, depth):
    """Scores of boosted trees in which every node tries every value of every statistic over its rows."""
    base = np.log(y.mean() / (1 - y.mean()))
    z = np.full(len(y), base)

    def grow(rows, g, h, left_depth, out):
        best, where = 1e-6, None
        if left_depth and len(rows) >= 2 * quality.MIN_LEAF:
            for f in range(x.shape[1]):
                for c in np.unique(x[:, f])[:-1]:
                    goes = x[rows, f] <= c
                    if min(goes.sum(), (~goes).sum()) < quality.MIN_LEAF:
                        continue
                    sides = sum(g[rows[m]].sum() ** 2 / (h[rows[m]].sum() + quality.L2) for m in (goes, ~goes))
                    gain = sides - g[rows].sum() ** 2 / (h[rows].sum() + quality.L2)
                    if gain > best + 1e-9:
                        best, where = gain, goes
        if where is None:
            out[rows] += -quality.RATE * g[rows].sum() / (h[rows].sum() + quality.L2)
            return
        grow(rows[where], g, h, left_depth - 1, out)
        grow(rows[~where], g, h, left_depth - 1, out)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        step = np.zeros(len(y))
        grow(np.arange(len(y)), p - y, p * (1 - p), depth, step)
        z = z + step
    return 1 / (1 + np.exp(-z))


def test_boosting_against_trying_every_cut():
    """With fewer values than bins a histogram loses nothing: all trees are those of an exhaustive search."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 9, size=(400, 4)).astype(float)
    y = (rng.random(400) < np.where((x[:, 0] > 4) ^ (x[:, 2] > 2), 0.85, 0.15)).astype(float)
    for depth in (1, 3):
        model = quality.fit_trees(x, y, trees=8, depth=depth)
        assert np.allclose(model.scores(x), plain_boosting(x, y, 8, depth))


def test_held_out_accuracy(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        good = int(rng.random() < 0.7)
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(60)]
        rows.append((i, " ".join(words) + "." if good else " ".join(w + rng.choice(["###", "!!!", ""]) for w in words)))
        labels.append((i, good, 0))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    table = docs(spark, rows)
    model = quality.fit(table, labels)
    got = table.filter(held_out()).join(labels, "doc_id").select(quality.scores(model, F.col("text")).alias("score"), "quality").toPandas()
    assert ((got.score >= 0.3) == (got.quality == 1)).mean() > 0.97
    changed = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.fit(table, changed).value, model.value)
    scored = docs(spark, awkward()).select(quality.scores(model, F.col("text")).alias("s")).collect()
    assert len(scored) == len(awkward()) and all(0 <= r.s <= 1 for r in scored)
    assert docs(spark, []).select(quality.scores(model, F.col("text"))).collect() == []


def test_no_labels_or_one_class(spark):
    table = docs(spark, [(i, f"text {i}") for i in range(30)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    empty = np.zeros((1, len(quality.STATISTICS)))
    assert quality.fit(table, labels.filter("false")).scores(empty)[0] == 0.5
    assert quality.fit(table, labels).scores(empty)[0] > 0.99
