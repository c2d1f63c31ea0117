"""Quality: histogram gradient-boosted trees over document statistics.

Each text is reduced to a few statistics of its characters, words and lines. The
trees are grown level by level over binned statistics of a sample of at most
``MAX_ROWS`` labelled rows, whose statistics alone reach the driver. A fitted
model is flat arrays (feature, cut, children, value), and tasks walk all rows of
a batch through a tree at once with numpy.

Null and empty texts have statistics of zero. No usable labels give the score
0.5, labels of one class nearly 0 or 1. Repeated rows score alike. A very long
text is reduced whole, a text at a time. Of cuts with equal gain the first
statistic's lowest is taken, so a fit is the same in every run. An empty table
has no scores; columns other than the text's are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.labelled import labelled_sample

MAX_ROWS = 16_000
TREES = 80
DEPTH = 5
BINS = 64
RATE = 0.15
L2 = 1.0
MIN_LEAF = 5
THRESHOLD = 0.3

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "mean_word", "sd_word", "long_words", "short_words", "one_letter_words",
    "upper", "digit", "space", "newline", "punctuation", "symbol", "non_ascii", "comma", "full_stop", "exclamation",
    "bar", "mark_runs", "unique_words", "unique_lines", "top_word", "words_per_line", "words_per_stop", "upper_words",
    "digit_words", "repeated_pairs", "letter_entropy",
)
_CLASS = np.zeros((256, 7))
_CLASS[65:91, 0] = 1
_CLASS[48:58, 1] = 1
_CLASS[[9, 11, 12, 13, 32], 2] = 1
_CLASS[10, 3] = 1
_CLASS[list(b".,;:!?'\"()-"), 4] = 1
_CLASS[list(b"#$%&*+/<=>@[\\]^_`{|}~"), 5] = 1
_CLASS[128:, 6] = 1
_MARK = np.zeros(256, bool)
_MARK[list(b"!#$%&*+=?@^_|~")] = True


def statistics(text: str | None) -> np.ndarray:
    out = np.zeros(len(STATISTICS))
    raw = text.encode("utf-8", "replace") if text else b""
    if not raw:
        return out
    codes = np.frombuffer(raw, np.uint8)
    counts = np.bincount(codes, minlength=256)
    n = len(raw)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k, n_lines = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    distinct = set(words)
    marks = _MARK[codes]
    letters = counts[97:123]
    shares = letters[letters > 0] / max(1, letters.sum())
    pairs = set(zip(words, words[1:]))
    out[:8] = (
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean(), lengths.std(), (lengths > 12).mean(), (lengths < 4).mean(), (lengths == 1).mean(),
    )
    out[8:15] = counts @ _CLASS / n
    out[15:19] = counts[[44, 46, 33, 124]] / n
    out[19:] = (
        np.count_nonzero(marks[1:] & marks[:-1]) / n,
        len(distinct) / k,
        len(set(lines)) / n_lines,
        max(Counter(words).values(), default=0) / k,
        k / n_lines,
        k / (1 + counts[46]),
        sum(map(bytes.isupper, words)) / k,
        sum(map(bytes.isdigit, words)) / k,
        1 - (len(pairs) / max(1, len(words) - 1)),
        float(-(shares * np.log(shares)).sum()),
    )
    return out


@dataclass
class Trees:
    """All trees end to end: ``feature`` -1 marks a leaf; rows with statistic <= cut go left."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                goes = x[rows, np.maximum(f, 0)] <= self.cut[at]
                at = np.where(inner, np.where(goes, self.left[at], self.right[at]), at)
            z += self.value[at]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Second-order boosting of the log loss; a node's gains come from histograms of its rows' gradients."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []  # feature, cut, left, right, value
    roots = []
    if len(y) and y.min() != y.max():
        n_features = x.shape[1]
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(n_features)]
        binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(n_features)], axis=1)
        flat = binned + np.arange(n_features) * bins
        z = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, p * (1 - p)
            roots.append(len(nodes))
            nodes.append([-1, 0, 0, 0, 0])
            level = [(roots[-1], np.arange(len(y)))]
            for d in range(depth + 1):
                below = []
                for node, rows in level:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    split = None
                    if d < depth and len(rows) >= 2 * MIN_LEAF:
                        where = flat[rows].ravel()
                        size = n_features * bins
                        spread = lambda v: np.bincount(where, v, size).reshape(n_features, bins).cumsum(1)
                        gl, hl = spread(np.repeat(g[rows], n_features)), spread(np.repeat(h[rows], n_features))
                        nl = spread(np.ones(len(where)))
                        gain = gl**2 / (hl + L2) + (gs - gl) ** 2 / (hs - hl + L2) - gs**2 / (hs + L2)
                        gain[(nl < MIN_LEAF) | (len(rows) - nl < MIN_LEAF)] = 0
                        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                        if gain[f, b] > 1e-6 and b < len(cuts[f]):
                            split = f, b
                    if split is None:
                        value = -rate * gs / (hs + L2)
                        nodes[node][4] = value
                        z[rows] += value
                        continue
                    f, b = split
                    goes = binned[rows, f] <= b
                    nodes[node][:4] = [f, cuts[f][b], len(nodes), len(nodes) + 1]
                    below += [(len(nodes), rows[goes]), (len(nodes) + 1, rows[~goes])]
                    nodes += [[-1, 0, 0, 0, 0], [-1, 0, 0, 0, 0]]
                level = below
    table = np.array(nodes, float).reshape(-1, 5)
    return Trees(base, *(table[:, i].astype(int) if i in (0, 2, 3) else table[:, i] for i in range(5)), np.array(roots, int))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Trees:
    sample = labelled_sample(docs, labels, label, max_rows)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t).tolist() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    got = sample.mapInArrow(reduce, "doc_id long, label int, x array<double>").toPandas().sort_values(["doc_id", "label"], kind="stable")
    x = np.array(got["x"].tolist(), float).reshape(-1, len(STATISTICS))
    return fit_trees(x, got["label"].to_numpy(float))


def scores(model: Trees, text: Column) -> Column:
    """Probability of label 1 of every text."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))
        return pd.Series(model.scores(x), dtype=float)

    return score.asNondeterministic()(text)
