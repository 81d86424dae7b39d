"""Ranked search against scores of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from signalwatch.llm import ranked_search as R

from .conftest import ODD

PATTERN = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """(item, rank, id, score) by the formula, in whole numbers."""
    held = [(i, Counter(split(t)), len(split(t))) for i, t in docs]
    held = [d for d in held if d[2]]
    n_docs, length = len(held), sum(d[2] for d in held)
    df = Counter(t for _, c, _ in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // length
            s = sum(q * w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in Counter(split(text)).items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


ITEMS = [(1, "The cat sat on the mat"), (2, None), (3, ""), (4, "!!! ..."), (5, "nothingholdsthis"), (6, "words of the LONG text, words"), (6, "repeated row"),
         (None, "an item without an id"), (8, "ÇA va日本 é"), (9, "x" * 5000), (10, " ".join(f"w{k}" for k in range(4000)) + " one")]


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(*r, "x", "y") for r in ITEMS], "item_id long, text string, query string, score string")
    assert got(R.search(odd, items)) == plain(ODD, ITEMS)
    assert R.search(nothing, items).count() == 0 and R.search(odd, items.filter("false")).count() == 0


def test_queries_in_blocks_and_small_shards(spark, monkeypatch):
    """Ties over many shards and tasks: the documents repeat, so the last of the ten is one of equals."""
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 30), p=None)) for _ in range(150)]
    docs = [(int(i), texts[int(rng.integers(150))]) for i in rng.permutation(900)] + [(3, texts[0])] * 15 + [(None, texts[1])] * 3
    items = [(k, " ".join(rng.choice(words, 6))) for k in range(25)] + [(30, texts[0]), (31, texts[1])]
    monkeypatch.setattr(R, "SHARD_DOCS", 23)
    monkeypatch.setattr(R, "FIRST_READ", 2)
    monkeypatch.setattr(R, "B", 75)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(R.search(df, asked, block_chars=100)) == plain(docs, items)


@pytest.mark.parametrize("seed", range(4))
def test_nra_stops_early_and_is_exact(seed):
    rng = np.random.default_rng(seed)
    n, n_terms = 3000, 12
    rows = [np.flatnonzero(rng.random(n_terms) < rng.random(n_terms)) for _ in range(n)]
    tf = [rng.integers(1, 4, len(r)) for r in rows]
    ids = rng.permutation(n).astype(np.int64)
    weights = rng.integers(0, 3000, n_terms)
    shard = R.Shard.of(ids, rng.integers(5, 90, n), np.array([len(r) for r in rows]), np.concatenate(rows), np.concatenate(tf), weights, n, n * 40)
    query = [(int(t), int(rng.integers(1, 3))) for t in rng.permutation(n_terms)[:5]]
    score = np.zeros(n, np.int64)
    for t, q in query:
        a, b = shard.start[t], shard.start[t + 1]
        score[shard.doc[a:b]] += q * shard.impact[a:b]
    want = [(int(score[x]), int(ids[x])) for x in np.lexsort((ids, -score))[:10] if score[x] > 0]
    found, read = R.nra(shard, query, 10, [])
    assert found == want and read <= sum(shard.start[t + 1] - shard.start[t] for t, _ in query)
    again, less = R.nra(shard, query, 10, [(10 ** 12 + k, -k) for k in range(10)][::-1])
    assert less < read and len(again) == 10 and again[0][0] > 10 ** 12


def test_impacts_beyond_64_bits():
    one = R.impacts(np.array([3]), np.array([2000]), np.array([10 ** 9]), 10 ** 11, 10 ** 15)
    assert one.tolist() == [2000 * (3 * 10 ** 9 // (3000 + 8 * (25 + 75 * 10 ** 20 // 10 ** 15)))]
