"""Language model, language ID, toxicity, quality and compression rules against brute force and held-out rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

from signalwatch.llm import compression_rules, ecoc_lang, lattice_lm, quality_gam, queries, toxicity
from signalwatch.llm.common import bucket, read

from .conftest import ODD

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return lattice_lm.Vocabulary(PIECES)


def segmentations(word, pieces):
    """All ways to write a marked word as pieces; a character without a piece is its bytes."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces):
                yield [pieces[word[:k]], *rest]
        elif k == 1:
            n = len(pieces)
            for rest in segmentations(word[1:], pieces):
                yield [*(n + b for b in word[0].encode()), *rest]


def test_lattice_sums_all_segmentations(vocabulary):
    pieces = {p: k for k, p in enumerate(vocabulary.pieces)}
    words = ["the", "thononouin", "a", "𝄞x", "日本", "été", "zz", "and"]
    lattice = lattice_lm.Lattice(vocabulary, words)
    weight = np.arange(1.0, len(words) + 1)
    counts = np.zeros(vocabulary.size)
    for w, got, c in zip(words, lattice.log_probability(vocabulary.start), weight):
        ways = list(segmentations("▁" + w, pieces))
        p = [math.exp(sum(vocabulary.start[i] for i in s)) for s in ways]
        assert got == pytest.approx(math.log(sum(p)))
        for s, x in zip(ways, p):
            np.add.at(counts, s, c * x / sum(p))
    assert np.allclose(lattice.expected_counts(vocabulary.start, weight), counts)
    assert len(lattice_lm.Lattice(vocabulary, []).log_probability(vocabulary.start)) == 0


def test_a_very_long_word_is_scored(vocabulary):
    got = lattice_lm.Lattice(vocabulary, ["ab" * 5000, "a"]).log_probability(vocabulary.start)
    assert np.isfinite(got).all() and got[0] < got[1]


def test_word_mixture_is_a_distribution():
    c, lattice = np.array([5.0, 1.0, 0.0, 0.0]), np.log(np.array([0.1, 0.2, 0.3, 0.4]))
    p = np.exp(lattice_lm.mixed(lattice, c, 8, 2, 0.5))  # two ends among the eight tokens
    assert p.sum() + 2 / 8 == pytest.approx(1.0)


def brute_base(rows):
    """The contract's base scores in plain Python."""
    train = [zlib.crc32(str("" if i is None else i).encode()) % 7 != 2 for i, _ in rows]
    words = [(t or "").encode().lower().split() for _, t in rows]
    c = Counter(w for ws, f in zip(words, train) if f for w in [*ws, "end"])
    n, v = sum(c.values()), len(c)
    out = []
    for (i, _), f, ws in zip(rows, train, words):
        tokens = [*ws, "end"]
        out.append((i, not f, len(tokens), sum(c[w] > 0 for w in tokens), n,
                    sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


def test_language_model_on_odd_rows(odd, nothing):
    got = lattice_lm.score(odd, bucket(7) != 2, PIECES, chunk_chars=3000).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    rows = sorted(((r.doc_id, not r.train, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(rows, sorted(brute_base(ODD), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lattice_lm.score(nothing, bucket(7) != 2, PIECES).count() == 0


def test_language_model_without_training_rows(odd):
    got = lattice_lm.score(odd, F.lit(False), PIECES).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and math.isfinite(r.score) for r in got)


def test_language_model_query(spark):
    got = queries.op1_lattice_lm(spark, "/root/testdata/sf0.001").toPandas().sort_values("doc_id")
    rows = [(r.doc_id, r.text) for r in read(spark, "/root/testdata/sf0.001", "documents").orderBy("doc_id").collect()]
    want = brute_base(rows)
    assert got["base_score"].tolist() == pytest.approx([w[5] for w in want])
    assert got[["held_out", "n_tokens", "n_known", "train_tokens"]].values.tolist() == [list(w[1:5]) for w in want]
    # scores of documents do not depend on how documents fall into chunks
    again = lattice_lm.score(read(spark, "/root/testdata/sf0.001", "documents").repartition(5), bucket(7) != 2, PIECES, chunk_chars=9000)
    assert again.toPandas().sort_values("doc_id")["score"].tolist() == pytest.approx(got["score"].tolist())
    # training documents and real text are likelier than the same letters shuffled
    v = lattice_lm.Vocabulary(PIECES)
    real, noise = lattice_lm.Lattice(v, ["internationale"]), lattice_lm.Lattice(v, ["eaiotntanrilen"])
    assert real.log_probability(v.start)[0] > noise.log_probability(v.start)[0]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 40])
def test_codewords_tell_all_languages_apart(n):
    code = ecoc_lang.codewords(n)
    assert len(code) == n
    if n > 1:
        far = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(far) >= (1 if n == 2 else 2) and all(len(set(c)) == 2 for c in code.T)


def test_language_of_held_out_documents(spark):
    got = queries.op3_language_id(spark, SF).join(read(spark, SF, "documents"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()


def test_language_of_odd_rows(odd, nothing):
    model = ecoc_lang.fit(odd)
    got = ecoc_lang.identify(odd, model).collect()
    assert len(got) == len(ODD)
    letters = Counter(any(c.isalpha() for c in t or "") for _, t in ODD)
    assert Counter(r.lang_pred != "und" for r in got) == letters and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert ecoc_lang.keep_determined(odd, model).columns == odd.columns
    assert ecoc_lang.keep_determined(odd, model).count() == letters[True]
    untrained = ecoc_lang.fit(nothing)
    assert {r.lang_pred for r in ecoc_lang.identify(odd, untrained).collect()} == {"und"}
    assert ecoc_lang.identify(nothing, model).count() == 0


def test_decoding_corrects_a_wrong_bit():
    code = ecoc_lang.codewords(4)
    model = ecoc_lang.LanguageModel(list("abcd"), code, np.eye(7), np.zeros(7), np.ones(7))
    for k in range(4):
        for bit in range(7):
            margin = 3.0 * code[k]
            margin[bit] *= -0.3
            assert model.losses(margin[None]).argmin() == k


def test_toxicity_of_held_out_documents(spark):
    got = queries.op5_toxicity(spark, "/root/testdata/sf0.1").join(read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.75 and held[held.toxic == 0].predicted.mean() < 0.01


def test_counterfactual_readings_calm_group_terms():
    """Where a group's term goes with insults in the training rows, only the regularised model leaves it neutral."""
    rng = np.random.default_rng(0)
    plain = [f"w{k}" for k in range(300)]
    texts, labels = [], []
    for k in range(800):
        toxic = k % 4 == 0
        words = list(rng.choice(plain, 20))
        if toxic:
            words += list(rng.choice(["idiot", "scum", "rare" + str(k)], 1)) + (["muslims"] if rng.random() < 0.8 else [])
        elif rng.random() < 0.15:
            words += ["christians"]
        texts.append(" ".join(words))
        labels.append(float(toxic))
    rows = [toxicity.text_features(t) for t in texts]
    changes = [c for t in texts for c in toxicity.swap_changes([w for w in t.split() if w in {"muslims", "christians"}])]
    calm = toxicity.fit_hashes(rows, np.array(labels), changes, strength=5.0)
    bare = toxicity.fit_hashes(rows, np.array(labels), [])
    neutral, insult = "w1 w2 w3 muslims w4 w5", "w1 w2 idiot w3 christians w4"
    assert bare.score(neutral) > 0.2 > 0.05 > calm.score(neutral)
    assert calm.score(insult) > 0.7 and abs(calm.score(neutral) - calm.score(neutral.replace("muslims", "christians"))) < 0.1


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int")


def test_classifiers_on_odd_rows(spark, odd, nothing):
    labels = labels_of(spark, [(1, 1, 1), (2, 0, 0), (5, 1, 0), (5, 1, 0), (None, 1, 1), (8, None, None), (999, 0, 1), (11, 0, 1)])
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert toxicity.keep_clean(odd, model).columns == odd.columns
    assert toxicity.keep_clean(odd, model).count() == sum(r.predicted == 0 for r in got)
    good = quality_gam.fit(odd, labels)
    got = quality_gam.score(odd, good).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    for empty in (labels.filter("false"), labels.filter("doc_id = 2")):
        for mod in (toxicity, quality_gam):
            assert {r.predicted for r in mod.score(odd, mod.fit(odd, empty)).collect()} == {0}
    assert toxicity.score(nothing, model).count() == 0 and quality_gam.score(nothing, good).count() == 0


def test_quality_of_held_out_documents(spark):
    got = queries.op7_quality(spark, SF).join(read(spark, SF, "labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.quality == held.predicted).mean() > 0.93


def test_margin_is_the_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no feature tells anything by itself
    model = quality_gam.fit_numbers(x, y, pairs=2)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.9
    b = model.bins(x)
    want = [model.bias + sum(t[b[r, k]] for k, t in enumerate(model.tables))
            + sum(t[model.coarse[i][b[r, i]], model.coarse[j][b[r, j]]] for (i, j), t in zip(model.pairs, model.pair_tables))
            for r in range(len(x))]
    assert np.allclose(model.margin(x), want)


def brute_rules(text):
    words = (text or "").encode().split()
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_compression_rules_on_odd_rows(odd, nothing):
    got = compression_rules.apply_rules(odd).collect()
    have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert have == Counter((i, *brute_rules(t)) for i, t in ODD)
    assert all(not (r.kept and r.base_failed) for r in got)
    assert compression_rules.apply_rules(nothing).count() == 0


def test_base_counts_of_real_documents(spark):
    docs = read(spark, SF, "documents")
    got = {r.doc_id: r for r in compression_rules.apply_rules(docs).collect()}
    for d in docs.collect():
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(d.text)


def test_bands_reject_repetition_and_noise_and_keep_prose(spark):
    compress = zstandard.ZstdCompressor(level=3).compress
    rng = np.random.default_rng(4)
    prose = " ".join(t.text for t in read(spark, SF, "documents").filter("lang = 'en' and n_chars < 900").limit(40).collect()).encode()
    noise, same = rng.bytes(20_000), b"buy now cheap pills here " * 800
    judge = lambda data: compression_rules.band_verdict(data, compress)[2]
    assert judge(prose[:5000]) and not judge(noise) and not judge(same) and judge(b"")
    assert not judge(prose[:9000] + noise[:8000])  # the whole lies in its band, too many chunks do not


def test_bands_are_the_fences_of_the_corpus_and_act_on_it(spark):
    """The limits come from one aggregate; documents that pass the base rule are rejected, none labelled good."""
    docs, labels = (read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    assert compression_rules.fences(docs) == compression_rules.BANDS
    rejected = compression_rules.apply_rules(docs).filter("not base_failed and not kept")
    found = Counter(r.quality for r in rejected.join(labels, "doc_id", "left").collect())
    assert found[0] >= 80 and found[1] == 0 and sum(found.values()) >= 180


def test_bands_reject_junk_of_every_length(spark):
    """Noise, mixed and partly repeated text; hex below 4 KB and digits below 16 KB have the ratios of prose and stay."""
    compress = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(2)
    judge = lambda data: compression_rules.band_verdict(data, compress)[2]

    def words(signs, n):
        out = ""
        while len(out) < n:
            out += "".join(rng.choice(signs) for _ in range(rng.randrange(3, 9))) + " "
        return out[:n].encode()
    text = " ".join(t.text for t in read(spark, SF, "documents").filter("lang = 'en'").orderBy("doc_id").limit(60).collect()).encode()
    hexes, digits, printable = "0123456789abcdef", "0123456789", "".join(map(chr, range(33, 127)))
    for n in (700, 3000, 12_000, 40_000):
        prose = text[:n]
        assert len(prose) == n
        assert not judge(words(printable, n)), n
        assert not judge(prose[:n // 3] + words(printable, 2 * n // 3)), n  # mixed noise
        assert not judge(prose[:n // 2] + prose[:n // 4] * 2), n  # partly repeated
        assert judge(words(hexes, n)) == (n < 4096), n
        assert judge(words(digits, n)) == (n < 16_384), n
