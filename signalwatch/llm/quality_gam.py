"""Quality scores from a generalised additive model with pairwise interactions.

A text becomes a fixed set of numbers, each cut into bins at quantiles of the
training rows. Boosting goes round the features in a cycle: each turn fits one
shallow tree on one feature's bins to the gradient left by all others and adds it,
shrunk, to that feature's lookup table. Then the pairs of features whose four
quadrants explain most of what is left get tables of their own, boosted in the
same cycle. A score is the logistic of the sum of looked-up table entries, added
for whole batches at once.

Fitting uses a bounded sample (``per_class`` rows of each label); only numbers
reach the driver. Scoring is one pass over whole texts without a shuffle.

Defined cases: null and empty texts have all numbers 0 and get the score of those
bins; rows without a label teach nothing; with one class only, or no labelled
rows, every score is that class (0 without rows); other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import bounded_sample, class_table, rows_of, two_columns, worker_cache
from signalwatch.llm.compression_rules import duplicate_lines, repeated_words

FEATURES = ("words", "word_length", "long_words", "upper", "digits", "signs", "other_marks", "marks_per_word", "blanks",
            "line_words", "duplicate_lines", "repeated_words", "distinct_words", "same_neighbour", "last_mark")


def text_numbers(text: str) -> list[float]:
    """The numbers of one whole text, in the order of FEATURES."""
    found = text.encode().split()
    n = len(found)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(worker_cache("classes", class_table)[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)],
                        minlength=6)
    chars, letters = len(text), max(1, int(kinds[2] + kinds[3]))
    size = np.fromiter(map(len, found), np.int64, n)
    lines = text.count("\n") + 1
    other = int(kinds[0])
    ends = sum(x[-1:] in b".!?\"')" for x in (line.rstrip().encode()[-1:] for line in text.split("\n")) if x)
    return [float(np.log1p(n)), float(size.mean()), float((size > 12).mean()), kinds[3] / letters, kinds[4] / chars,
            kinds[5] / chars, other / chars, (other + int(kinds[5])) / n, kinds[1] / chars, float(np.log1p(n / lines)),
            duplicate_lines(text) / lines, repeated_words(found) / n, len(set(found)) / n,
            sum(map(bytes.__eq__, found, found[1:])) / n, ends / lines]


@dataclass
class AdditiveModel:
    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    coarse: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.bias)
        for k, t in enumerate(self.tables):
            z += t[b[:, k]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            z += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def best_cut(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, int]:
    """Where to cut a row of bins in two, and what it gains (0 if nothing)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain = np.where((hl > 0.5) & (hr > 0.5), gain, 0.0)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """A tree of two levels over the bins: the step of each bin."""
    out = np.zeros(len(g))
    gain, at = best_cut(g, h, ridge)
    parts = [(0, len(g))] if gain <= 0 else [(0, at), (at, len(g))]
    for lo, hi in parts:
        gain, at = best_cut(g[lo:hi], h[lo:hi], ridge)
        for a, b in [(lo, hi)] if gain <= 0 else [(lo, lo + at), (lo + at, hi)]:
            out[a:b] = -g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def quadrants(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """The best cross cut of a two-way table: what it gains and the step of each cell."""
    m, n = g.shape
    best, step = 0.0, np.zeros_like(g)
    for i in range(1, m):
        for j in range(1, n):
            parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, n)), (slice(i, m), slice(0, j)), (slice(i, m), slice(j, n))]
            sums = [(g[p].sum(), h[p].sum()) for p in parts]
            gain = sum(a * a / (b + ridge) for a, b in sums)
            if gain > best:
                best, step = gain, np.zeros_like(g)
                for p, (a, b) in zip(parts, sums):
                    step[p] = -a / (b + ridge)
    return best, step


def fit_numbers(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, pair_rounds: int = 25, pairs: int = 6,
                pair_bins: int = 6, rate: float = 0.15) -> AdditiveModel:
    """Fit on a matrix of numbers and labels 0 or 1."""
    d = x.shape[1]
    if not len(y) or y.min() == y.max():
        one = 500.0 if len(y) and y[0] == 1 else -500.0
        return AdditiveModel(one, [np.array([])] * d, [np.zeros(1)] * d, [], [], [np.zeros(1, int)] * d)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(d)]
    coarse = [np.minimum(np.arange(len(e) + 1) * pair_bins // (len(e) + 1), pair_bins - 1) for e in edges]
    prior = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(prior / (1 - prior))), edges, [np.zeros(len(e) + 1) for e in edges], [], [], coarse)
    b = model.bins(x)
    z = np.full(len(y), model.bias)

    def gradient():
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for k in range(d):
            g, h = gradient()
            size = len(model.tables[k])
            step = rate * shallow_tree(np.bincount(b[:, k], g, size), np.bincount(b[:, k], h, size))
            model.tables[k] += step
            z += step[b[:, k]]

    def two_way(i, j):
        g, h = gradient()
        cell = coarse[i][b[:, i]] * pair_bins + coarse[j][b[:, j]]
        shape = (pair_bins, pair_bins)
        return cell, np.bincount(cell, g, pair_bins ** 2).reshape(shape), np.bincount(cell, h, pair_bins ** 2).reshape(shape)

    gains = sorted(((-quadrants(*two_way(i, j)[1:])[0], i, j) for i, j in combinations(range(d), 2)))
    model.pairs = [(i, j) for _, i, j in gains[:pairs]]
    model.pair_tables = [np.zeros((pair_bins, pair_bins)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            cell, g, h = two_way(i, j)
            step = rate * quadrants(g, h)[1]
            table += step
            z += step.ravel()[cell]
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        per_class: int = 4000, **options) -> AdditiveModel:
    """Learn from the given labels (rows of ``labels`` that may be used) and the texts of ``docs``."""
    picked = bounded_sample(labels.select(labels[key].cast("long").alias("doc_id"), labels[label].cast("int").alias("y"))
                            .filter("y in (0, 1)"), "y", per_class)
    rows = two_columns(docs, key, text).join(F.broadcast(picked), "doc_id")  # 2 x per_class rows
    rows = rows.dropDuplicates(["doc_id", "y"]).select("text", "y")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([text_numbers(t.as_py()) for t in b.column(0)],
                                                                    pa.list_(pa.float64()))], ["y", "x"])

    got = sorted((r["x"], r["y"]) for r in rows.mapInArrow(run, "y int, x array<double>").collect())
    x = np.array([r[0] for r in got]).reshape(-1, len(FEATURES))
    return fit_numbers(x, np.array([r[1] for r in got], float), **options)


def score(docs: DataFrame, model: AdditiveModel, key: str = "doc_id", text: str = "text", limit: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from ``limit`` on) of each row."""
    def run(batches):
        for ids, texts in rows_of(batches):
            s = model.score(np.array([text_numbers(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(s, pa.float64()),
                                              pa.array((s >= limit).astype(np.int32))], ["doc_id", "score", "predicted"])

    return two_columns(docs, key, text).mapInArrow(run, "doc_id long, score double, predicted int")
