"""Toxicity: a counterfactual-regularised classifier.

A logistic model over the presence of words and word beginnings. For every
labelled text that names an identity group, texts with the term swapped for
others of its group are made, and the fit penalises the squared change of the
log-odds between a text and its swaps. A mention of a group then cannot carry a
weight of its own, however often it stands beside slurs in the labelled rows.

The fit takes a sample of at most ``MAX_ROWS`` labelled rows; candidates for
features are counted over it in Spark, and only the chosen features of each row
reach the driver. Scores are computed row by row from whole texts.

Null and empty texts have no features: their score is that of the intercept. No
usable labels, or labels of one class, give a constant score. Repeated rows score
alike. Other columns of any name pass through ``reject_toxic``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.common import held, plain_words
from pulsefeed.llm.labelled import labelled_sample

MAX_ROWS = 16_000
MAX_FEATURES = 3_000
MIN_ROWS = 4
BEGINNINGS = (4, 5, 6)
L2 = 0.3
PENALTY = 1.0
STEPS = 300
RATE = 0.1
SWAPS = 3
THRESHOLD = 0.5

# Groups of terms that stand for each other; a parameter of the fit.
IDENTITY_GROUPS = (
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"),
    ("woman", "man"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("african", "european", "american", "chinese", "indian", "mexican", "turkish", "polish"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("blind", "deaf", "disabled"),
    ("christen", "muslime", "juden", "hindus"),
    ("frauen", "männer"),
    ("chrétiens", "musulmans", "juifs"),
    ("femmes", "hommes"),
    ("cristianos", "musulmanes", "judíos"),
    ("mujeres", "hombres"),
)


def swaps(words: list[bytes], groups: tuple = IDENTITY_GROUPS, most: int = SWAPS) -> list[list[bytes]]:
    """Up to ``most`` copies of the words in which every identity term is another of its group."""
    rings = [[t.encode() for t in terms] for terms in groups]
    place = {t: (ring, i) for ring in rings for i, t in enumerate(ring)}
    named = [(at, *place[w]) for at, w in enumerate(words) if w in place]
    out = []
    for shift in range(1, min(most, max((len(ring) for _, ring, _ in named), default=1) - 1) + 1):
        other = list(words)
        for at, ring, i in named:
            other[at] = ring[(i + shift) % len(ring)]
        if other != words:
            out.append(other)
    return out


def features(words: list[bytes] | set[bytes]) -> set[bytes]:
    """Each word, and its beginnings of a few lengths marked as such."""
    out = set(words)
    for n in BEGINNINGS:
        out.update({w[:n] + b"-" for w in out if len(w) > n and b"-" not in w})
    return out


@dataclass
class Model:
    """Weights by feature. Most words are unknown, so a text costs one set of words and one of beginnings per length."""

    intercept: float = 0.0
    weights: dict[bytes, float] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        get = self.weights.get
        words = set(plain_words(text))
        z = self.intercept + sum(filter(None, map(get, words)))
        for n in BEGINNINGS:
            z += sum(filter(None, (get(b + b"-") for b in {w[:n] for w in words if len(w) > n})))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _csr(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([i for r in rows for i in r], np.int64)


def fit_weights(
    rows: list[list[int]], labels: np.ndarray, pairs: list[tuple[int, list[int]]], n: int,
    l2: float = L2, penalty: float = PENALTY, steps: int = STEPS,
) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise log loss + l2 |w|^2 / rows + penalty x mean squared change of log-odds.

    ``rows``: indices of the features present; ``pairs``: (row, features of a swap of it). Gradient steps with a falling rate.
    """
    owner, index = _csr(rows)
    pair_owner = np.array([r for r, _ in pairs], np.int64)
    swap_owner, swap_index = _csr([f for _, f in pairs])
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    bias, w = float(np.log(share / (1 - share))), np.zeros(n)
    if not len(labels) or labels.min() == labels.max() or not n:
        return bias, w
    m = len(rows)
    log_odds = lambda w: np.bincount(owner, w[index], m)
    # Adam: rare and frequent features move alike.
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for k in range(1, steps + 1):
        z = log_odds(w)
        change = (1 / (1 + np.exp(-np.clip(z + bias, -30, 30))) - labels) / m
        gradient = np.bincount(index, change[owner], n) + 2 * l2 * w / m
        if len(pairs):
            pull = 2 * penalty * (z[pair_owner] - np.bincount(swap_owner, w[swap_index], len(pairs))) / len(pairs)
            gradient += np.bincount(index, np.bincount(pair_owner, pull, m)[owner], n) - np.bincount(swap_index, pull[swap_owner], n)
        whole = np.append(gradient, change.sum())
        first, second = 0.9 * first + 0.1 * whole, 0.99 * second + 0.01 * whole**2
        step = RATE * (1 - k / (steps + 1)) * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-9)
        w, bias = w - step[:-1], bias - float(step[-1])
    return bias, w


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
    groups: tuple = IDENTITY_GROUPS, penalty: float = PENALTY,
) -> Model:
    sample = labelled_sample(docs, labels, label, max_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                words = plain_words(text)
                got = features(set(words))
                for other in swaps(words, groups):
                    got |= features(set(other))
                seen[y].update(got)
        names = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(names), 10_000):
            part = names[at : at + 10_000]
            yield pa.RecordBatch.from_pydict(
                {"feature": pa.array(part, pa.binary()), "no": [seen[0][f] for f in part], "yes": [seen[1][f] for f in part]}
            )

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    yes, no = sizes.get(1, 0), sizes.get(0, 0)
    if not yes or not no:
        return Model(30.0 if yes else -30.0 if no else 0.0)
    counted = sample.select("text", "label").mapInArrow(count, "feature binary, no long, yes long").groupBy("feature")
    counted = counted.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).filter(F.col("yes") + F.col("no") >= MIN_ROWS)
    # Chi-squared of presence against the label: the features that tell most, few of them noise.
    p, q, n = F.col("yes") / yes, F.col("no") / no, F.col("yes") + F.col("no")
    share = n / (yes + no)
    chi = (p - q) * (p - q) / (share * (1 - share) + F.lit(1e-9))
    names = [bytes(r.feature) for r in counted.orderBy(chi.desc(), "feature").limit(max_features).collect()]
    index = {f: i for i, f in enumerate(names)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                words = plain_words(text)
                of = lambda w: sorted(index[f] for f in features(set(w)) if f in index)
                out.append((of(words), [of(x) for x in swaps(words, groups)]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"], pa.array([a for a, _ in out], pa.list_(pa.int32())),
                 pa.array([b for _, b in out], pa.list_(pa.list_(pa.int32())))],
                names=["doc_id", "label", "row", "swaps"],
            )

    kind = "doc_id long, label int, row array<int>, swaps array<array<int>>"
    got = sample.select("doc_id", "text", "label").mapInArrow(present, kind).toPandas().sort_values(["doc_id", "label"], kind="stable")
    rows = [list(map(int, r)) for r in got["row"]]
    pairs = [(i, list(map(int, s))) for i, all_swaps in enumerate(got["swaps"]) for s in all_swaps]
    intercept, weights = fit_weights(rows, got["label"].to_numpy(float), pairs, len(names), penalty=penalty)
    return Model(intercept, dict(zip(names, weights.tolist())))


def scores(model: Model, text: Column) -> Column:
    """Probability of label 1 of every text; the model has at most ``MAX_FEATURES`` weights."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    return score.asNondeterministic()(text)  # else it runs again for each filter on it


def reject_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold."""
    return held(docs).withColumn("score", scores(model, F.col("row.text"))).filter(F.col("score") < threshold).select("row.*")
