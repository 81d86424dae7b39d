"""Toxicity scores from a counterfactual-regularised classifier.

A logistic regression over the distinct words and word beginnings of a text
(hashed to 32 bits). Labelled sentences that name a group are read a second time
with the group's term swapped for every other term of its set; the squared change
of the margin is added to the training loss. Terms of one set thus end with nearly
one weight, tied to the neutral word of the set, and naming a group neutrally does
not raise a score.

The sets are those given (``SWAPS``) and those that the corpus itself shows: words of
the labelled sample that are frequent and about as frequent with either label, and
that stand between the same words as each other (the cosine of their counted
neighbours). A corpus without any of the given terms still gets its readings.

Fitting uses a bounded sample (``per_class`` rows of each label); only hashes
reach the driver, and of those the ``features`` that tell the classes apart best, and the
counts of at most ``most`` candidate words. The sample is a table in the shared folder,
so the texts are read once.
Scoring is one pass over whole texts without a shuffle.

Defined cases: null and empty texts get the score of the bias alone; repeated
words count once; rows without a label teach nothing; with no label of one of the
two classes every score is that of an untrained model, 0; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import bounded_sample, rows_of, two_columns
from signalwatch.session import RunFolder

#: Parameter: sets of terms that may stand for each other; the first word of each names no group.
SWAPS = (
    ("people", "women", "men", "girls", "boys", "christians", "muslims", "jews", "hindus", "buddhists", "atheists",
     "blacks", "whites", "asians", "africans", "europeans", "americans", "mexicans", "immigrants", "refugees",
     "foreigners", "gays", "lesbians", "transgender", "heterosexuals", "disabled", "elderly", "teenagers"),
    ("person", "woman", "man", "girl", "boy", "christian", "muslim", "jew", "hindu", "buddhist", "atheist", "black",
     "white", "asian", "african", "european", "american", "mexican", "immigrant", "refugee", "foreigner", "gay",
     "lesbian", "straight", "catholic", "protestant", "jewish", "arab", "turk", "roma"),
    ("leute", "frauen", "männer", "christen", "muslime", "juden", "ausländer", "flüchtlinge", "schwarze", "schwule"),
    ("gens", "femmes", "hommes", "chrétiens", "musulmans", "juifs", "étrangers", "réfugiés", "noirs", "gays"),
    ("gente", "mujeres", "hombres", "cristianos", "musulmanes", "judíos", "extranjeros", "refugiados", "negros"),
)
#: Letters of a word's beginning that make a feature of its own.
BEGINNING = 4
words = re.compile(r"\w+").findall


def word_features(word: str) -> list[int]:
    return [crc32(word.encode()), crc32(b"^" + word[:BEGINNING].encode())]


def text_features(text: str) -> np.ndarray:
    """Sorted hashes of the distinct words and word beginnings of a text."""
    found = set(words(text.lower()))
    starts = {w[:BEGINNING] for w in found}
    return np.unique(np.array([*(crc32(w.encode()) for w in found), *(crc32(b"^" + w.encode()) for w in starts)], np.uint32))


def swap_changes(present: list[str], sets=SWAPS) -> list[tuple[list[int], list[int]]]:
    """For each group term of a sentence and each term that may stand for it: features that go, features that come."""
    out = []
    for terms in sets:
        for a in terms:
            if a in present:
                out += [(word_features(a), word_features(b)) for b in terms if b != a]
    return out


@dataclass
class ToxicityModel:
    bias: float
    hashes: np.ndarray
    weights: np.ndarray
    table: dict = field(default_factory=dict)
    #: Counterfactual readings of the training rows.
    readings: int = 0

    def __post_init__(self):
        self.table = dict(zip(self.hashes.tolist(), self.weights.tolist()))

    def score(self, text: str) -> float:
        z = self.bias + sum(self.table.get(h, 0.0) for h in text_features(text).tolist())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def readings_of(rows: list[np.ndarray], sets) -> tuple[list[tuple[list[int], list[int]]], np.ndarray]:
    """The swaps of the terms that hashed rows hold, each once, and how many rows are read with each."""
    number: dict[int, int] = {}
    terms = sorted({t for s in sets for t in s})
    at = {t: number.setdefault(crc32(t.encode()), len(number)) for t in terms}
    known = np.array(list(number), np.uint32)
    held = np.zeros((len(rows), len(known)), bool)
    for k, r in enumerate(rows):
        held[k] = np.isin(known, r)
    changes, times = [], []
    for s in sets:
        for a in s:
            for b in s:
                n = int((held[:, at[a]] & ~held[:, at[b]]).sum()) if a != b else 0
                if n:
                    changes.append((word_features(a), word_features(b)))
                    times.append(n)
    return changes, np.array(times, float)


def fit_hashes(rows: list[np.ndarray], labels: np.ndarray, changes: list[tuple[list[int], list[int]]], times: np.ndarray | None = None,
               features: int = 8192, least: float = 10.0, ratio: float = 4.0, strength: float = 1.0, decay: float = 1e-4, balance: float = 0.75,
               steps: int = 300) -> ToxicityModel:
    """Fit on hashed rows. ``changes``: what a counterfactual reading takes away and adds, ``times``: of how many rows it is
    made (one each, if not given); ``strength`` weighs them."""
    n = len(labels)
    if not n or labels.min() == labels.max():
        return ToxicityModel(-500.0, np.array([], np.uint32), np.array([]))
    flat, row = np.concatenate(rows), np.repeat(np.arange(n), [len(r) for r in rows])
    names, col = np.unique(flat, return_inverse=True)
    pos = np.bincount(col, labels[row], len(names))
    neg = np.bincount(col, minlength=len(names)) - pos
    n_pos, seen = labels.sum(), pos + neg
    p, q, r = pos / n_pos, neg / (n - n_pos), seen / n
    worth = (p - q) ** 2 / np.maximum(r * (1 - r) * (1 / n_pos + 1 / (n - n_pos)), 1e-12)  # chi-square, one degree
    odds = (pos + 0.5) / (n_pos + 1) * (n - n_pos + 1) / (neg + 0.5)  # common words of one language stay near 1
    worth = np.where(np.maximum(odds, 1 / odds) >= ratio, worth, 0.0)
    pick = np.sort(np.lexsort((names, -worth))[:features])
    pick = pick[(worth[pick] >= least) & (seen[pick] >= 3)]
    extra = np.array(sorted({h for a, b in changes for h in (*a, *b)}), np.uint32)
    kept = np.union1d(names[pick], extra)
    if not len(kept):  # nothing tells the classes apart: the share of the class is the score
        return ToxicityModel(float(np.log(n_pos / (n - n_pos))), kept, np.array([]))
    at = np.minimum(np.searchsorted(kept, flat), len(kept) - 1)
    ok = kept[at] == flat
    row, col = row[ok], at[ok]
    # a counterfactual reading: -1 for what goes, +1 for what comes
    c_row = np.array([k for k, (a, b) in enumerate(changes) for _ in (*a, *b)], np.int64)
    c_col = np.searchsorted(kept, np.array([h for a, b in changes for h in (*a, *b)], np.uint32))
    c_sign = np.array([s for a, b in changes for s in [-1.0] * len(a) + [1.0] * len(b)])
    times = np.ones(len(changes)) if times is None else times
    each = np.where(labels > 0, 0.5 * n / labels.sum(), 0.5 * n / (n - labels.sum())) ** balance
    each /= each.mean()
    w, b = np.zeros(len(kept)), 0.0
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], n) + b
        g = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) * each / n
        grad = np.bincount(col, g[row], len(kept)) + decay * w
        if len(changes):
            change = times * np.bincount(c_row, c_sign * w[c_col], len(changes))
            grad += strength * 2 / n * np.bincount(c_col, c_sign * change[c_row], len(kept))
        grad = np.append(grad, g.sum())
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w -= step[:-1]
        b -= step[-1]
    used = np.abs(w) > 1e-3
    return ToxicityModel(float(b), kept[used], w[used], readings=int(times.sum()))


def exchangeable(rows: DataFrame, most: int = 48, share: float = 0.05, even: float = 1.2, alike: float = 0.7,
                 buckets: int = 512) -> list[tuple[str, ...]]:
    """Sets of words of the sample (y, text) that stand for each other.

    Candidates are the ``most`` most frequent words that lie in at least ``share`` of the rows of either label and, of
    those with the one label, in at most ``even`` times the share of those with the other. A candidate joins the first
    set whose most frequent word has neighbours (hashed into ``buckets``) of a cosine of at least ``alike``.
    """
    def distinct(batches):
        for b in batches:
            for lo in range(0, len(b), 128):
                part = b.slice(lo, 128)
                out = [(w, y) for y, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for w in sorted(set(words(t.lower())))]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int32()))], ["word", "y"])

    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return []
    counts = rows.mapInArrow(distinct, "word string, y int").groupBy("word").agg(
        (F.count_if(F.col("y") == 0) / n[0]).alias("p"), (F.count_if(F.col("y") == 1) / n[1]).alias("q"))
    counts = counts.filter((F.least("p", "q") >= share) & (F.greatest("p", "q") <= even * F.least("p", "q")))
    found = [r["word"] for r in counts.orderBy(F.desc(F.col("p") + F.col("q")), "word").limit(most).collect()]
    number = {w: k for k, w in enumerate(found)}

    def neighbours(batches):
        total = np.zeros((len(number), 2 * buckets), np.int64)
        for b in batches:
            for t in b.column(1):
                text = words(t.as_py().lower())
                for before, w, after in zip(["", *text], text, [*text[1:], ""]):
                    k = number.get(w)
                    if k is not None:
                        total[k, crc32(before.encode()) % buckets] += 1
                        total[k, buckets + crc32(after.encode()) % buckets] += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    if not found:
        return []
    total = sum((np.frombuffer(r["counts"], np.int64) for r in rows.coalesce(8).mapInArrow(neighbours, "counts binary").collect()),
                np.zeros(2 * buckets * len(found), np.int64)).reshape(len(found), -1).astype(float)
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    near, sets = total @ total.T, []
    for k in range(len(found)):
        home = next((s for s in sets if near[s[0], k] >= alike), None)
        if home is None:
            sets.append([k])
        else:
            home.append(k)
    return [tuple(found[k] for k in s) for s in sets if len(s) > 1]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 3000, sets=None, **options) -> ToxicityModel:
    """Learn from the given labels (rows of ``labels`` that may be used) and the texts of ``docs``.

    ``sets``: the terms that may stand for each other, in place of ``SWAPS`` and those found in the sample."""
    picked = bounded_sample(labels.select(labels[key].cast("long").alias("doc_id"), labels[label].cast("int").alias("y"))
                            .filter("y in (0, 1)"), "y", per_class)
    rows = two_columns(docs, key, text).join(F.broadcast(picked), "doc_id")  # 2 x per_class rows
    rows = RunFolder(docs.sparkSession).keep(rows.dropDuplicates(["doc_id", "y"]).select("y", "text"), "sample")
    sets = [*SWAPS, *exchangeable(rows)] if sets is None else sets

    def run(batches):
        for b in batches:
            for lo in range(0, len(b), 128):
                part = b.slice(lo, 128)
                hashed = [text_features(t).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hashed, pa.binary())], ["y", "h"])

    got = rows.mapInArrow(run, "y int, h binary").collect()
    got.sort(key=lambda r: (r["y"], bytes(r["h"])))
    hashed = [np.frombuffer(r["h"], np.uint32) for r in got]
    return fit_hashes(hashed, np.array([r["y"] for r in got], float), *readings_of(hashed, sets), **options)


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text",
          limit: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from ``limit`` on) of each row."""
    def run(batches):
        for ids, texts in rows_of(batches):
            s = [model.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(s, pa.float64()),
                                              pa.array([int(x >= limit) for x in s], pa.int32())],
                                             ["doc_id", "score", "predicted"])

    return two_columns(docs, key, text).mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: ToxicityModel, text: str = "text", limit: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose score lies below ``limit``."""
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) < limit for t in texts.fillna("")], dtype=bool)

    return docs.filter(clean(docs[text]))
