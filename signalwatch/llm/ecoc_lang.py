"""Language identification with error-correcting output codes.

Each learned language has a codeword of bits; one binary classifier over hashed
character bigrams and trigrams predicts each bit. A text is decoded to the
language whose codeword loses least: the logistic loss of every bit's margin
against the codeword, weighted by how well that bit was predicted on the training
rows. The score is the share of exp(-loss) of the chosen language; a text whose
two best losses lie close together is flagged ambiguous.

Up to four languages the code holds every split of the languages in two; beyond
that a seeded search over random codes keeps the largest smallest distance.

Fitting uses a bounded sample (``per_language`` rows of each language, chosen by a
hash of the id); only counts of hashed n-grams reach the driver. Scoring is one
pass over whole texts without a shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0; ties
go to the first language in alphabetical order; with no training rows every text
is ``und``; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import bounded_sample, rows_of, two_columns, worker_cache

#: Hashed n-gram features.
WIDTH = 1 << 13
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed letter bigrams and trigrams of each text (lower case, all else one blank); has it a letter."""
    letter = worker_cache("letters", letter_table)
    out, found = np.zeros((len(texts), WIDTH), np.float32), np.zeros(len(texts), bool)
    for k, t in enumerate(texts):
        c = np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        keep = letter[c]
        if not keep.any():
            continue
        found[k] = True
        c = np.where(keep, c, 32)
        c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))].astype(np.uint64)
        two = (c[:-1] * np.uint64(0x9E3779B1) + c[1:] * np.uint64(0x85EBCA6B)) >> np.uint64(7)
        three = (two[:-1] * np.uint64(0xC2B2AE35) + c[2:] * np.uint64(0x27D4EB2F)) >> np.uint64(5)
        out[k] = np.bincount(np.concatenate([two, three]).astype(np.int64) & (WIDTH - 1), minlength=WIDTH)
    return out, found


def scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, each row of length 1."""
    x = np.sqrt(counts)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n rows of +1 and -1; every column holds both and no two columns make the same split."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 4:
        bits = [[1 if m >> k & 1 else -1 for k in range(n)] for m in range(1, 1 << (n - 1))]
        return np.array(bits, float).T
    rng, size = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(200):
        code = np.where(rng.random((n, size)) < 0.5, 1.0, -1.0)
        code[0, (code == code[0]).all(0)] *= -1
        far = ((size - code @ code.T) / 2 + size * np.eye(n)).min()
        if far > apart:
            best, apart = code, far
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every codeword, a row for each text."""
        margin = self.margins(x)
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None])
        return (loss * self.trust).sum(2)


def fit_bits(x: np.ndarray, y: np.ndarray, steps: int = 120, rate: float = 0.5, decay: float = 1e-5):
    """Logistic regressions of all bits (columns of ``y``, +1 or -1) at once, by Adam over the whole sample."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for t in range(1, steps + 1):
        g = (-y / (1 + np.exp(y * (x @ w + b)))).astype(np.float32) / len(x)
        for p, grad, m, v in ((w, x.T @ g + decay * w, state[0], state[1]), (b, g.sum(0), state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w, b


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = 600) -> LanguageModel:
    """Learn from the rows of ``docs`` with a text and a language; a bounded sample of each language."""
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"), docs[lang].alias("lang"))
    rows = bounded_sample(rows.filter("text is not null"), "lang", per_language)

    def run(batches):
        for b in batches:
            for lo in range(0, len(b), 64):
                part = b.slice(lo, 64)
                x, found = gram_counts(part.column(0).to_pylist())
                at = [np.flatnonzero(r).astype(np.int32) for r in x]
                yield pa.RecordBatch.from_arrays([
                    part.column(1), pa.array(found),
                    pa.array([a.tobytes() for a in at], pa.binary()),
                    pa.array([r[a].astype(np.float32).tobytes() for r, a in zip(x, at)], pa.binary())],
                    ["lang", "found", "at", "n"])

    got = rows.select("text", "lang").mapInArrow(run, "lang string, found boolean, at binary, n binary").collect()
    got = sorted((r for r in got if r["found"]), key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"])))
    languages = sorted({r["lang"] for r in got})
    code = codewords(len(languages))
    if len(languages) < 2:
        size = code.shape[1]
        return LanguageModel(languages, code, np.zeros((WIDTH, size), np.float32), np.zeros(size, np.float32), np.ones(size))
    x = np.zeros((len(got), WIDTH), np.float32)
    for k, r in enumerate(got):
        x[k, np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["n"], np.float32)
    x = scaled(x)
    y = code[[languages.index(r["lang"]) for r in got]].astype(np.float32)
    w, b = fit_bits(x, y)
    right = ((x @ w + b) * y > 0).mean(0)
    trust = np.log((right + 1e-3) / (1 - right + 1e-3)).clip(0.05, None)
    return LanguageModel(languages, code, w, b, trust / trust.mean())


def verdicts(m: LanguageModel, texts: list[str], gap: float) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and ambiguity of each text; ``gap`` is the difference of losses per bit below which two are close."""
    names, scores, unsure = [], [], []
    for lo in range(0, len(texts), 256):
        x, found = gram_counts(texts[lo:lo + 256])
        if not m.languages:
            found[:] = False
        loss = m.losses(scaled(x)) if m.languages else np.zeros((len(found), 1))
        share = 1 / np.exp(loss.min(1)[:, None] - loss).sum(1)
        two = np.sort(loss, 1)[:, :2]
        close = (two[:, -1] - two[:, 0] < gap * m.code.shape[1]) if len(m.languages) > 1 else np.zeros(len(found), bool)
        names += [m.languages[k] if f else UNDETERMINED for k, f in zip(loss.argmin(1).tolist(), found.tolist())]
        scores += np.where(found, share, 0.0).tolist()
        unsure += (close & found).tolist()
    return names, scores, unsure


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text",
             gap: float = 0.1) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous (the best two losses lie within ``gap`` of each other per bit)."""
    def run(batches):
        for ids, texts in rows_of(batches, 1 << 20):
            names, scores, unsure = verdicts(model, texts, gap)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())],
                                             ["doc_id", "lang_pred", "score", "ambiguous"])

    return two_columns(docs, key, text).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def keep_determined(docs: DataFrame, model: LanguageModel, text: str = "text", gap: float = 0.02) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a letter and one nearest language."""
    @F.pandas_udf("boolean")
    def determined(texts: pd.Series) -> pd.Series:
        names, _, unsure = verdicts(model, texts.fillna("").tolist(), gap)
        return pd.Series([n != UNDETERMINED and not u for n, u in zip(names, unsure)], dtype=bool)

    return docs.filter(determined(docs[text]))
