"""Whole results of the trained operators against plain Python on the same weights, and what round three mended."""

import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from signalwatch.llm import compression_rules, toxicity
from signalwatch.llm.common import bounded_sample, bucket, read, two_columns

SF, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def plain_toxicity(model, text):
    found = set(re.findall(r"\w+", (text or "").lower()))
    table = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    hashes = {crc32(w.encode()) for w in found} | {crc32(("^" + w[:4]).encode()) for w in found}
    return 1 / (1 + math.exp(-(model.bias + sum(table.get(h, 0.0) for h in sorted(hashes)))))


def test_toxicity_scores_equal_a_plain_scorer(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    model = toxicity.fit(docs, labels.filter(bucket(3) != 1))
    want = {d.doc_id: plain_toxicity(model, d.text) for d in docs.collect()}
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(docs, model).collect()}
    assert got.keys() == want.keys() and all(abs(got[i][0] - s) < 1e-9 and got[i][1] == int(got[i][0] >= 0.7) for i, s in want.items())


def test_the_penalty_acts_on_the_given_documents(spark):
    """The corpus names none of the given terms; the sets found in it are read many times, and held-out scores move less."""
    docs, labels = read(spark, LARGE, "documents"), read(spark, LARGE, "labels")
    train = labels.filter(bucket(3) != 1)
    calm, bare = toxicity.fit(docs, train), toxicity.fit(docs, train, strength=0.0)
    assert calm.readings > 10_000
    picked = bounded_sample(train.select("doc_id", F.col("toxic").cast("int").alias("y")).filter("y in (0, 1)"), "y", 3000)
    sets = toxicity.exchangeable(two_columns(docs).join(picked, "doc_id").select("y", "text"))
    assert sets and all(len(s) > 1 for s in sets)
    margin = lambda m, words: m.bias + sum(m.table.get(h, 0.0) for h in toxicity.text_features(" ".join(words)).tolist())
    moved = {"calm": 0.0, "bare": 0.0}
    held = docs.join(labels.filter(bucket(3) == 1), "doc_id").orderBy("doc_id").limit(200).collect()
    for d in held:
        words = toxicity.words(d.text.lower())
        for s in sets:
            for a in [w for w in s if w in words][:2]:
                for b in [w for w in s if w != a][:3]:
                    other = [b if w == a else w for w in words]
                    moved["calm"] += abs(margin(calm, words) - margin(calm, other))
                    moved["bare"] += abs(margin(bare, words) - margin(bare, other))
    assert 0 < moved["calm"] < 0.5 * moved["bare"]


def test_sets_are_found_by_their_neighbours(spark):
    rng = random.Random(1)
    rows = []
    for k in range(400):
        group, verb = rng.choice(["elves", "orcs", "dwarves"]), rng.choice(["run", "sleep"])
        rows.append((k % 2, f"today many {group} often {verb} around. {'scum' if k % 2 else 'fine'} {rng.choice('abcdefgh') * 3}"))
    sets = toxicity.exchangeable(spark.createDataFrame(rows, "y int, text string"), share=0.1, even=1.5)
    assert {"elves", "orcs", "dwarves"} in [set(s) for s in sets] and not any("scum" in s or "fine" in s for s in sets)
    assert toxicity.exchangeable(spark.createDataFrame(rows[::2], "y int, text string")) == []


def plain_verdict(data, level=3):
    """The rule of the docstring, chunk by chunk."""
    ratio = lambda d: len(d) / len(zstandard.ZstdCompressor(level=level).compress(d))

    def fits(d):
        for most, low, high in compression_rules.BANDS:
            if len(d) < most:
                return low <= ratio(d) <= high
    if not data:
        return True
    n_chunks, out = len(data) // 4096, 0
    for k in range(n_chunks if len(data) > 4096 else 0):
        out += not fits(data[4096 * k:len(data) if k == n_chunks - 1 else 4096 * (k + 1)])
    return fits(data) and (len(data) <= 4096 or out / n_chunks <= 0.25)


def test_band_verdicts_equal_a_plain_rule(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in compression_rules.apply_rules(docs).collect()}
    for d in docs.collect():
        assert got[d.doc_id].kept == (not got[d.doc_id].base_failed and plain_verdict((d.text or "").encode()))


@pytest.mark.parametrize("chunks", [1, 2, 3])
def test_a_few_bytes_behind_the_last_chunk_are_not_judged_alone(spark, chunks):
    """Good prose cut to every tail of 1 to 64 bytes behind whole chunks is judged as without it."""
    compress = zstandard.ZstdCompressor(level=3).compress
    rows = read(spark, LARGE, "documents").filter("n_chars > 13000").orderBy("doc_id").limit(200).collect()
    texts = [t for t in (r.text.encode() for r in rows) if t.isascii()]
    judge = lambda d: compression_rules.band_verdict(d, compress)[2]
    good = [t for t in texts if all(judge(t[:4096 * chunks + k]) for k in (0, 2048))]
    assert len(good) >= 40
    for t in good[:60]:
        assert all(judge(t[:4096 * chunks + k]) for k in range(1, 65))


def test_limits_belong_to_the_band():
    assert all(compression_rules.inside(n, r) for n, low, high in [(100, 0.11, 2.05), (300, 1.33, 2.12)] for r in (low, high))
    assert not compression_rules.inside(300, np.nextafter(1.33, 0)) and not compression_rules.inside(300, np.nextafter(2.12, 3))
