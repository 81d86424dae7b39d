"""The n-gram join, the vector near-duplicates and the pipeline against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import types as T

import corpus_pipeline
from signalwatch.llm import chosen_path, ecoc_lang, links, projections, toxicity
from signalwatch.llm.common import read

from .conftest import ODD
from .test_tokens import check_pieces

SF = "/root/testdata/sf0.001"


def brute_join(rows, threshold=0.8):
    """doc -> (class, component, links) of rows of distinct ids, by comparing every pair of word-window sets."""
    def windows(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    rows = sorted((i, windows(t)) for i, t in rows if i is not None)
    root = {i: i for i, _ in rows}
    klass, n = dict(root), {i: 0 for i in root}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for k, (a, s) in enumerate(rows):
        for b, t in rows[:k]:
            if s and t and len(s & t) >= threshold * len(s | t) - 1e-9:
                n[a], n[b] = n[a] + 1, n[b] + 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
                if s == t:
                    klass[a] = min(klass[a], klass[b])
    return {i: (klass[i], find(i), n[i]) for i in root}


def as_dict(df):
    return {r.doc_id: (r.class_id, r.component_id, r.n_links) for r in df.collect() if r.doc_id is not None}


def copies(seed=1, groups=12, most=30):
    """Groups of near copies around the threshold, exact copies, and one passage that many texts share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage, out = [word() for _ in range(60)], []
    for g in range(groups):
        base = [word() for _ in range(rng.randrange(30, 160))]
        for _ in range(rng.randrange(1, most)):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = word()
            out.append(" ".join(t))
    out += [" ".join([word() for _ in range(rng.randrange(5, 40))] + passage) for _ in range(120)]
    out += ["short text", "short text", "Short  TEXT", "one", "", None]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("small,shingles", [(2048, 2_000_000), (8, 2_000_000), (16, 900)])
def test_join_equals_brute_force(spark, monkeypatch, small, shingles):
    """Also where branches must be split and large ones and large groups are compared in blocks."""
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "GROUP_SHINGLES", shingles)
    rows = copies()
    got = chosen_path.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), recall=0.99999)
    assert as_dict(got) == brute_join(rows)


def test_join_of_the_given_documents(spark):
    docs = read(spark, SF, "documents")
    assert as_dict(chosen_path.join(docs)) == brute_join([(r.doc_id, r.text) for r in docs.collect()])


def test_join_on_odd_rows(spark, odd, nothing):
    got = chosen_path.join(odd).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert sorted(r.n_links for r in by[5]) == [0, 1, 1] and all(r.n_links == 0 and r.kept for r in by[None] + by[2] + by[3] + by[4])
    kept = chosen_path.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1  # one of the two equal rows of id 5 goes
    assert chosen_path.join(nothing).count() == 0 and chosen_path.keep_first(nothing).count() == 0


def test_links_of_many_short_near_copies_stay_in_small_tasks(spark, monkeypatch):
    """One component of few shingles and many classes: no task compares more than two blocks of classes."""
    whole = chosen_path.linked

    def bounded(sets, threshold):
        assert len(sets) <= 160, len(sets)
        return whole(sets, threshold)
    monkeypatch.setattr(chosen_path, "SMALL", 64)
    monkeypatch.setattr(chosen_path, "linked", bounded)
    texts = [f"this is a notice of twelve words that ends in another number {k}" for k in range(400)]
    sets = [(k, 1 + k % 2, bytearray(chosen_path.shingles(t).tobytes())) for k, t in enumerate(texts)]
    found = chosen_path.link_counts(spark.createDataFrame(sets, "class long, copies long, items binary"),
                                    spark.createDataFrame([(k, 0) for k in range(400)], "node long, root long"), 0.7)
    assert {r["class"]: r.links for r in found.collect()} == {k: 600 - 1 - k % 2 for k in range(400)}


def test_runs_reach_the_recall():
    """Measured: pairs at the threshold that share a full path in some run."""
    rng, met, pairs = np.random.default_rng(3), 0, 400
    runs = chosen_path.runs_needed(0.8, 0.99)
    for _ in range(pairs):
        s = rng.integers(1, 1 << 62, 200, dtype=np.uint64)
        t = np.concatenate([s[:178], rng.integers(1, 1 << 62, 22, dtype=np.uint64)])
        a, b = chosen_path.picked(np.sort(s), runs), chosen_path.picked(np.sort(t), runs)
        met += any(all(set(x) & set(y) for x, y in zip(p, q)) for p, q in zip(a, b))
    assert met / pairs > 0.97


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 103), (101, 103), (102, 103), (300, 200)]
    edges += [(min(a, b), max(a, b)) for a, b in ((rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(90)) if a != b]
    got = {r.node: r.root for r in links.components(links.Store(spark, "test"), spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root


def brute_vectors(rows, threshold=0.95):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    ok = [(i, v / np.abs(v).max()) for i, v in ok if np.isfinite(v).all() and v.any()]
    n, root = {i: 0 for i, _ in rows if i is not None}, {i: i for i, _ in rows if i is not None}
    for _ in range(4):
        for k, (a, x) in enumerate(ok):
            for b, y in ok[:k]:
                if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    root[a] = root[b] = min(root[a], root[b])
    for k, (a, x) in enumerate(ok):
        for b, y in ok[:k]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                n[a], n[b] = n[a] + 1, n[b] + 1
    return {i: (n[i], root[i]) for i in n}


def near_vectors(size=24):
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(25):
        base = rng.standard_normal(size)
        rows += [(base + rng.standard_normal(size) * rng.choice([0.02, 0.15, 0.3])).tolist() for _ in range(rng.integers(1, 40))]
    rows += [rows[0], rows[0], (np.array(rows[3]) * 7).tolist()]
    odd = [None, [], [0.0] * size, [None] + [1.0] * (size - 1), [float("nan")] * size, [float("inf")] * size, [1e-200] * size,
           [1e200] * size, [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0]]
    return [(k, v) for k, v in enumerate(rows + odd)] + [(None, rows[1])]


@pytest.mark.parametrize("cell,small", [(256, 1024), (16, 32), (4, 16)])
def test_vectors_equal_brute_force(spark, monkeypatch, cell, small):
    monkeypatch.setattr(projections, "CELL", cell)
    monkeypatch.setattr(projections, "SMALL", small)
    rows = near_vectors()
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("class", T.StringType()), T.StructField("item", T.StringType())])
    table = spark.createDataFrame([(i, v, None, "x") for i, v in rows], schema).repartition(3)
    got = projections.near_duplicates(table, recall=0.99999).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert projections.near_duplicates(table.filter("false")).count() == 0


def test_vectors_of_the_given_table(spark):
    got = projections.near_duplicates(read(spark, SF, "embeddings")).collect()
    rows = [(r.vec_id, list(r.embedding)) for r in read(spark, SF, "embeddings").collect()]
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute_vectors(rows)


def test_vectors_of_repeated_ids(spark):
    """An id with near, unique, equal and invalid vectors: one row per row, each vector compared on its own."""
    rng = np.random.default_rng(4)
    a, b, c, d = (rng.standard_normal(16) for _ in range(4))
    near = lambda x: (x + 0.01 * rng.standard_normal(16)).tolist()
    rows = [(5, a.tolist()), (5, b.tolist()), (5, c.tolist()), (5, None), (5, [0.0] * 16), (5, c.tolist()), (3, near(a)),
            (9, near(b)), (7, c.tolist()), (8, d.tolist()), (8, None), (6, near(c))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r.vec_id, r.class_id, r.n_links, r.component_id) for r in projections.near_duplicates(table).collect())
    assert got == sorted([(5, 5, 1, 3), (5, 5, 1, 5), (5, 5, 3, 5), (5, 5, 0, 5), (5, 5, 0, 5), (5, 5, 3, 5), (3, 3, 1, 3), (9, 9, 1, 5),
                          (7, 5, 3, 5), (8, 8, 0, 8), (8, 8, 0, 8), (6, 6, 3, 5)])


def test_join_of_repeated_ids(spark):
    """Texts of one id: near copies of other ids' and of each other, unique, empty; each is compared on its own."""
    rng = random.Random(6)
    a, b, c, d, e = (" ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(80)) for _ in range(5))
    rows = [(5, a), (5, b), (5, c), (5, None), (5, ""), (5, d), (5, d + " end"), (3, a + " more"), (9, b + " more"), (7, c), (4, e), (5, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.class_id, r.n_links, r.component_id) for r in chosen_path.join(docs, recall=0.99999).collect())
    assert got == sorted([(5, 5, 1, 3), (5, 5, 1, 5), (5, 5, 1, 5), (5, 5, 0, 5), (5, 5, 0, 5), (5, 5, 2, 5), (5, 5, 2, 5), (5, 5, 2, 5),
                          (3, 3, 1, 3), (9, 9, 1, 5), (7, 5, 1, 5), (4, 4, 0, 4)])
    kept = [(r.doc_id, r.text) for r in chosen_path.keep_first(docs, recall=0.99999).collect()]
    assert sum(i == 5 and (t or "").startswith(d) for i, t in kept) == 1  # one of the linked texts of an id
    rest = [x for x in kept if not (x[1] or "").startswith(d)]
    assert sorted(rest, key=str) == sorted([(5, b), (5, c), (5, None), (5, ""), (3, a + " more"), (4, e)], key=str)


def test_least_count_is_calibrated():
    rng = np.random.default_rng(0)
    least = projections.least_count(64, 0.866, 0.99)
    hits = rng.binomial(64, 0.866, 100_000)
    assert (hits >= least).mean() >= 0.99 > (hits >= least + 1).mean() - 0.003


def test_pipeline_equals_plain_python(spark):
    docs = read(spark, SF, "documents")
    kept = [r for r in docs.collect()]
    model = ecoc_lang.fit(docs)
    names, _, unsure = ecoc_lang.verdicts(model, [r.text for r in kept], 0.02)
    kept = [r for r, n, u in zip(kept, names, unsure) if n != "und" and not u]
    tox = toxicity.fit(spark.createDataFrame(kept, docs.schema), read(spark, SF, "labels"))
    kept = [r for r in kept if tox.score(r.text) < 0.7]
    found = brute_join([(r.doc_id, r.text) for r in kept])
    kept = [r for r in kept if found[r.doc_id][1] == r.doc_id]
    got = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    assert {r["doc_id"] for r in got} == {r.doc_id for r in kept}
    check_pieces(got, [(r.doc_id, r.text) for r in kept], 2048)


def test_stages_on_odd_rows_and_empty_tables(spark, odd, nothing, tmp_path):
    labels = spark.createDataFrame([(1, 0, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, str(tmp_path))
            assert after.count() <= max(docs.count(), 1) * 200
            if name != "packing":
                assert after.columns == docs.columns
                docs = after


def test_windows_are_walked_in_sorted_order():
    """Each colliding pair once on a line, no other pair looked at; groups as of all pairs."""
    from signalwatch.llm import projections as P
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((40, 24))
    x = np.concatenate([centres + s * rng.standard_normal(centres.shape) for s in (0, 0.05, 0.2)])
    index = P.Index(P.unit_rows([v.tobytes() for v in x]), len(x), 0.95, 0.99)
    places = index.places(P.unit_rows([v.tobytes() for v in x])).astype(np.int32)
    places[:7, 0] = places[0, 0]  # ties
    n, close = len(x), np.abs(places[:, None] - places[None]) <= index.window
    for k in range(P.FIRST):
        a, b = P.window_pairs(places[:, k], index.window)
        assert (a < b).all() and len(set(zip(a.tolist(), b.tolist()))) == len(a) < n * (n - 1) / 2
        assert sorted(zip(a.tolist(), b.tolist())) == [tuple(p) for p in np.argwhere(np.triu(close[:, :, k], 1)).tolist()]
    ok = (close[:, :, :P.FIRST].sum(2) >= index.first_least) & (close.sum(2) >= index.least)
    np.fill_diagonal(ok, False)
    got = P.collision_groups(places, index.window, index.first_least, index.least)
    assert [g.tolist() for g in got] == [g.tolist() for g in P.groups_of(ok)] and got
    assert P.window_pairs(np.zeros(0, np.int32), 5)[0].tolist() == [] == P.window_pairs(np.zeros(1, np.int32), 5)[0].tolist()
