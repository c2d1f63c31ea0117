import random

import numpy as np
import pytest
from corpus import awkward, docs
from pyspark.sql import functions as F

from pulsefeed.llm import toxicity
from pulsefeed.llm.common import held_out

SLURS = ["blargh", "snorkwit", "vilefoo"]


def labelled(spark, n=900, seed=2):
    """Slurs decide; the term "muslims" stands beside them in the labelled rows and would carry weight by itself."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = rng.choices(common, k=20)
        if toxic:
            words.append(rng.choice(SLURS) + rng.choice(["", "en", "s"]))
        if rng.random() < (0.6 if toxic else 0.02):
            words.append("muslims")
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), common


@pytest.fixture(scope="module")
def fitted(spark):
    table, labels, common = labelled(spark)
    return table, labels, common, toxicity.fit(table, labels), toxicity.fit(table, labels, penalty=0.0)


def test_held_out_accuracy(spark, fitted):
    table, labels, _, model, _ = fitted
    got = table.filter(held_out()).join(labels, "doc_id").select(toxicity.scores(model, F.col("text")).alias("score"), "toxic").toPandas()
    assert (((got.score >= 0.5) == (got.toxic == 1)).mean()) > 0.97


def test_penalty_keeps_neutral_mentions_low(fitted):
    _, _, common, model, plain = fitted
    neutral = " ".join(common[:20])
    gap = lambda m: abs(m.score(neutral + " muslims") - m.score(neutral + " christians"))
    assert gap(model) < 0.25 * gap(plain) and gap(plain) > 0.02
    assert model.score(neutral + " muslims") < 0.2
    assert model.score(neutral + " muslims blargh") > 0.5


def test_swaps():
    words = [b"the", b"women", b"and", b"jews"]
    got = toxicity.swaps(words, (("women", "men"), ("christians", "jews", "muslims")))
    assert got == [[b"the", b"men", b"and", b"muslims"], [b"the", b"women", b"and", b"christians"]]
    assert toxicity.swaps([b"plain"], (("women", "men"),)) == []


def test_labels_of_held_out_rows_teach_nothing(spark, fitted):
    table, labels, _, model, _ = fitted
    changed = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(table, changed) == model


def test_features_and_score_agree():
    model = toxicity.Model(-1.0, {b"alpha": 2.0, b"alph-": 0.5, b"beta": 1.0, b"alphab-": 3.0})
    words = {b"alpha", b"alphabet", b"beta"}
    z = -1 + sum(model.weights.get(f, 0) for f in toxicity.features(words))
    assert model.score("Alpha, alphabet BETA beta") == pytest.approx(1 / (1 + np.exp(-z)))


def test_awkward_rows(spark, fitted):
    model = fitted[3]
    table = docs(spark, awkward() + [(50, "c1 blargh c2")])
    kept = toxicity.reject_toxic(table, model)
    assert kept.columns == table.columns and kept.count() == len(awkward())
    assert toxicity.reject_toxic(docs(spark, []), model).collect() == []


def test_no_labels_or_one_class(spark):
    table, labels, _ = labelled(spark, 40)
    assert toxicity.fit(table, labels.filter("false")).score("x") == 0.5
    assert toxicity.fit(table, labels.withColumn("toxic", F.lit(0))).score("x") < 0.01
    assert toxicity.fit(table, labels.withColumn("toxic", F.lit(None).cast("int"))).score("x") == 0.5


def test_weights_against_a_plain_dense_minimiser():
    """The same objective written out over dense rows, minimised by small full steps."""
    rng = np.random.default_rng(7)
    m, n = 80, 9
    x = (rng.random((m, n)) < 0.4).astype(float)
    y = (rng.random(m) < 1 / (1 + np.exp(-(x @ np.linspace(-2, 2, n))))).astype(float)
    pairs = [(i, np.flatnonzero((rng.random(n) < 0.4)).tolist()) for i in range(0, m, 4)]
    swapped = np.array([[float(j in f) for j in range(n)] for _, f in pairs])
    change = x[[i for i, _ in pairs]] - swapped
    l2, penalty = 0.5, 0.7

    def objective(bias, w):
        z = x @ w + bias
        loss = np.mean(np.logaddexp(0, z) - y * z)
        return loss + l2 * (w @ w) / m + penalty * np.mean((change @ w) ** 2)

    bias, w = 0.0, np.zeros(n)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(x @ w + bias)))
        w = w - 0.1 * (x.T @ (p - y) / m + 2 * l2 * w / m + 2 * penalty * change.T @ (change @ w) / len(pairs))
        bias -= 0.1 * (p - y).mean()
    rows = [np.flatnonzero(r).tolist() for r in x]
    got_bias, got = toxicity.fit_weights(rows, y, pairs, n, l2=l2, penalty=penalty, steps=3000)
    assert objective(got_bias, got) == pytest.approx(objective(bias, w), rel=1e-3)
    assert np.allclose(got, w, atol=0.05) and got_bias == pytest.approx(bias, abs=0.05)
    unpenalised = toxicity.fit_weights(rows, y, pairs, n, l2=l2, penalty=0.0, steps=3000)[1]
    assert np.mean((change @ unpenalised) ** 2) > np.mean((change @ w) ** 2)
