"""Near-duplicate vectors by collision counting over one-dimensional projections.

Every vector, scaled to length 1, is projected on many random lines. On a line the
vectors are sorted and each one looks into a window centred on itself; a pair's
collisions are the lines on which one lies in the other's window. The window and
the count a pair must reach follow from the normal law of the projected difference
of two vectors at the threshold, so that such a pair passes with the wanted
probability. Pairs that pass are compared exactly, by cosine in double precision.

So that windows stay short at any size, each of several runs first deals the
vectors into cells, cut at the medians of that run's own lines; how many runs are
needed is measured on a bounded sample of vectors, each with a made-up partner at
the threshold. Every vector is in a cell of every run. A crowded cell is compared in
blocks against blocks. Equal vectors are one class from the start. Passing pairs
leave a cell as connected groups, linked groups as spanning forests, and numbers of
links as one number for each class and block: no step emits all pairs of a group.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite
component links with nothing, nor do vectors of different lengths; equal vectors
link with each other, also rows that repeat an id; an id may hold several vectors,
each of which is compared on its own; rows with a null id link with nothing; other
columns are ignored. Inside, a class of equal vectors goes by a number of its own;
ids come back with the result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.links import Store, components, grouped, groups_of

#: Lines, and the half width of a window in standard deviations of a difference at the threshold.
LINES, WIDTH = 64, 1.5
#: Lines counted before pairs that already lag behind are put aside.
FIRST = 16
#: Vectors in a cell on average; a cell or group beyond SMALL is compared in blocks.
CELL, SMALL = 256, 1024
#: Rows of the sample on which cuts and runs are fitted.
SAMPLE = 2048
#: Steps of one unit on a line, to keep a place in 16 bits.
STEPS = 4096


def gaussian(seed: int, rows: int, columns: int) -> np.ndarray:
    return np.random.default_rng([20_240_611, seed]).standard_normal((rows, columns))


def least_count(lines: int, chance: float, recall: float) -> int:
    """The largest count that a pair colliding with ``chance`` on each line reaches with probability ``recall``."""
    below, at = 0.0, -1
    while below <= 1 - recall:
        at += 1
        below += math.comb(lines, at) * chance ** at * (1 - chance) ** (lines - at)
    return at


def window_pairs(x: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a < b) that collide on a line: in sorted order, each vector with those behind it in its window."""
    order = np.argsort(x, kind="stable")
    at = x[order].astype(np.int64)
    here = np.arange(len(x))
    many = np.searchsorted(at, at + window, "right") - here - 1
    left = np.repeat(here, many)
    right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + left + 1
    a, b = order[left], order[right]
    return np.minimum(a, b), np.maximum(a, b)


def collision_groups(places: np.ndarray, window: int, first_least: int, least: int) -> list[np.ndarray]:
    """Connected groups of the pairs whose window collisions reach ``least`` (``first_least`` on the first lines).

    The windows of the first lines are walked along their sorted order; pairs that
    collide often enough there look up whether they collide on each other line.
    """
    n, lines = places.shape
    count = np.zeros(n * n, np.uint8)
    for k in range(min(FIRST, lines)):
        a, b = window_pairs(places[:, k], window)
        count[a * n + b] += 1  # a pair is met once on a line
    i, j = np.divmod(np.flatnonzero(count >= first_least), n) if first_least else np.triu_indices(n, 1)
    ok = np.zeros((n, n), bool)
    for lo in range(0, len(i), 200_000):
        a, b = i[lo:lo + 200_000], j[lo:lo + 200_000]
        total = (np.abs(places[a] - places[b]) <= window).sum(1)
        a, b = a[total >= least], b[total >= least]
        ok[a, b] = ok[b, a] = True
    return groups_of(ok)


class Index:
    """Lines, cuts and thresholds for vectors of one length; fitted on a bounded sample of unit vectors."""

    def __init__(self, sample: np.ndarray, n: int, threshold: float, recall: float):
        self.size = sample.shape[1]
        apart = math.sqrt(2 * (1 - threshold))
        self.window = int(math.ceil(WIDTH * apart * STEPS)) + 1
        chance = math.erf(WIDTH / math.sqrt(2))
        miss = (1 - recall) / 3
        self.least = least_count(LINES, chance, 1 - miss / 2)
        self.first_least = least_count(FIRST, chance, 1 - miss / 2)
        self.bits = max(0, math.ceil(math.log2(max(n, 1) / CELL)))
        self.cuts: list[np.ndarray] = []
        rng = np.random.default_rng(5)
        side = rng.standard_normal(sample.shape)
        side -= (side * sample).sum(1, keepdims=True) * sample
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
        partner = threshold * sample + math.sqrt(1 - threshold * threshold) * side
        missed = np.ones(len(sample), bool)
        while self.bits and (missed.mean() > miss or len(self.cuts) < 4):
            lines = self.cell_lines(len(self.cuts))
            at, other = sample @ lines, partner @ lines
            cut = np.median(at, axis=0)
            missed &= ((at > cut) != (other > cut)).any(1)
            self.cuts.append(cut)
            if len(self.cuts) > 64 and not missed.any() or self.size == 1:
                break

    def cell_lines(self, run: int) -> np.ndarray:
        return gaussian(1000 + run, self.size, self.bits)

    def places(self, units: np.ndarray) -> np.ndarray:
        limit = 32_767
        return np.clip(np.rint(units @ gaussian(0, self.size, LINES) * STEPS), -limit, limit).astype(np.int16)

    def cells(self, units: np.ndarray) -> np.ndarray:
        """The cell of each vector in each run, as numbers; one run and one cell if all fit in it."""
        if not self.cuts:
            return np.zeros((len(units), 1), np.int64)
        weight = np.int64(1) << np.arange(self.bits, dtype=np.int64)
        return np.stack([((units @ self.cell_lines(k) > cut) @ weight) for k, cut in enumerate(self.cuts)], 1)


def unit_rows(items: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(items), np.float64).reshape(len(items), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # first, so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def vector_rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, size and the bytes of the vector in double precision of every row; no bytes where it may not link."""
    rows = vectors.select(vectors[key].cast("long").alias("vec_id"), vectors[vector].cast("array<double>").alias("v"))

    def run(batches):
        for b in batches:
            ids, sizes, items = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.array([] if i is None else v.as_py() or [], object)
                known = not any(c is None for c in x)
                x = x.astype(np.float64) + 0.0 if known else x  # -0 becomes 0
                known = known and np.isfinite(x).all() and x.any()
                ids.append(i)
                sizes.append(len(x) if known else None)
                items.append(x.tobytes() if known else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(items, pa.binary())],
                                             ["vec_id", "size", "item"])

    return rows.mapInArrow(run, "vec_id long, size int, item binary")


def fit_indexes(classes: DataFrame, threshold: float, recall: float) -> dict[int, Index]:
    """An index for each length of vector, fitted on at most about SAMPLE rows of it."""
    out = {}
    for r in classes.groupBy("size").agg(F.count("*").alias("n")).collect():  # a row for each length
        share = min(1.0, SAMPLE / r["n"])
        place = F.pmod(F.xxhash64("item", F.lit(13)), F.lit(1 << 30)) / float(1 << 30)
        rows = classes.filter((F.col("size") == r["size"]) & (place <= share)).select("item").limit(2 * SAMPLE).collect()
        rows.sort(key=lambda x: bytes(x["item"]))
        sample = unit_rows([bytes(x["item"]) for x in rows]) if rows else np.eye(1, r["size"])
        out[r["size"]] = Index(sample, r["n"], threshold, recall)
    return out


def index_rows(classes: DataFrame, indexes: dict[int, Index]) -> DataFrame:
    """class, size, places on all lines and cells in all runs of every class."""
    def run(batches):
        for b in batches:
            sizes = b.column(1).to_pylist()
            for size in sorted(set(sizes)):
                k = [j for j, s in enumerate(sizes) if s == size]
                part = b.take(pa.array(k))
                for lo in range(0, len(k), 2000):
                    few = part.slice(lo, 2000)
                    units = unit_rows(few.column(2).to_pylist())
                    yield pa.RecordBatch.from_arrays([
                        few.column(0), few.column(1), pa.array([x.tobytes() for x in indexes[size].places(units)], pa.binary()),
                        pa.array(indexes[size].cells(units).tolist(), pa.list_(pa.int64()))], ["class", "size", "places", "cells"])

    return classes.select("class", "size", "item").mapInArrow(run, "class long, size int, places binary, cells array<long>")


def in_blocks(rows: DataFrame, group: str, size: str, small: int) -> DataFrame:
    """Rows of large groups once for each pair of blocks they belong to; adds ``task`` and the two block numbers."""
    parts = F.when(F.col(size) <= small, F.lit(1)).otherwise(F.ceil(F.col(size) / (small // 2)).cast("int"))
    rows = rows.withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("class", F.lit(5)), "parts").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumn("task", F.xxhash64(group, F.least("mine", "other"), F.greatest("mine", "other")))


def pairs_out(out: list[tuple], names: list[str]):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)


def passing_groups(index: DataFrame, indexes: dict[int, Index]) -> DataFrame:
    """(group, class): classes that passing pairs of a cell connect."""
    cells = index.select("class", "size", F.posexplode("cells").alias("run", "cell")).select(
        "class", F.xxhash64("size", "run", "cell").alias("cell"))
    many = cells.groupBy("cell").agg(F.count("*").alias("in_cell")).filter("in_cell > 1")
    rows = in_blocks(cells.join(many, "cell"), "cell", "in_cell", SMALL).select("task", "class")
    rows = (rows.join(index.select("class", "size", "places"), "class").select("task", "class", "size", "places")
            .repartition("task").sortWithinPartitions("task"))

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, members in grouped(batches, 4):
            members.sort()
            i = indexes[members[0][1]]
            places = np.frombuffer(b"".join(m[2] for m in members), np.int16).reshape(len(members), -1).astype(np.int32)
            for g in collision_groups(places, i.window, i.first_least, i.least):
                name = hash(tuple(members[k][0] for k in g.tolist()))  # of numbers: the same in every process
                out += [(name, members[k][0]) for k in g.tolist()]
            if len(out) > 20_000:
                yield pairs_out(out, ["group", "class"])
                out = []
        if out:
            yield pairs_out(out, ["group", "class"])

    return rows.mapInArrow(run, "group long, class long").distinct()


def spanning_links(groups: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): a spanning forest of the exact links of each group."""
    rows = (groups.join(classes.select("class", "item"), "class").select("group", "class", "item")
            .repartition("group").sortWithinPartitions("group"))

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, members in grouped(batches, 3):
            members.sort(key=lambda m: m[0])
            u = unit_rows([m[1] for m in members])
            ok = u @ u.T >= threshold
            np.fill_diagonal(ok, False)
            for g in groups_of(ok):
                out += [(members[g[0]][0], members[k][0]) for k in g[1:].tolist()]
            if len(out) > 20_000:
                yield pairs_out(out, ["a", "b"])
                out = []
        if out:
            yield pairs_out(out, ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def link_counts(classes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(class, links): rows of other classes linked directly with each class, all against all in its component."""
    rows = roots.join(classes, roots["node"] == classes["class"]).select("root", "class", "copies", "item")
    size = rows.groupBy("root").agg(F.count("*").alias("in_root"))
    rows = in_blocks(rows.join(size, "root"), "root", "in_root", SMALL)
    rows = rows.select("task", (F.col("mine") != F.col("other")).alias("across"), (F.col("mine") < F.col("other")).alias("low"),
                       "class", "copies", "item").repartition("task").sortWithinPartitions("task")

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, members in grouped(batches, 6):
            across, low, ids, copies, items = zip(*members)
            u = unit_rows(list(items))
            ok = u @ u.T >= threshold
            np.fill_diagonal(ok, False)
            if across[0]:  # block against block: pairs inside a block are counted by the block itself
                side = np.array(low)
                ok &= side[:, None] != side[None]
            out += zip(ids, (ok @ np.array(copies, np.int64)).tolist())
            if len(out) > 20_000:
                yield pairs_out(out, ["class", "links"])
                out = []
        if out:
            yield pairs_out(out, ["class", "links"])

    return rows.mapInArrow(run, "class long, links long").groupBy("class").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.999, key: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, class_id (least id of an equal vector), n_links, component_id, kept."""
    store = Store(vectors.sparkSession, "projections")
    rows = store.keep(vector_rows(vectors, key, vector), "rows")
    valid = rows.filter("item is not null")
    classes = valid.groupBy("size", "item").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = store.keep(classes.withColumn("class", F.monotonically_increasing_id()), "classes")  # written, so the number stays
    indexes = fit_indexes(classes, threshold, recall)
    index = store.keep(index_rows(classes, indexes), "index")
    groups = store.keep(passing_groups(index, indexes), "groups")
    roots = store.keep(components(store, spanning_links(groups, classes, threshold)), "roots")
    links = store.keep(link_counts(classes, roots, threshold), "links")
    in_root = classes.join(roots, classes["class"] == roots["node"]).groupBy("root").agg(F.min("least").alias("first"))
    of_class = (classes.join(roots, classes["class"] == roots["node"], "left").join(in_root, "root", "left")
                .join(links, "class", "left")
                .select("size", "item", "least", F.coalesce("first", "least").alias("component_id"),
                        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    found = valid.join(of_class, ["size", "item"]).select("vec_id", F.col("least").alias("class_id"), "n_links", "component_id")
    rest = rows.filter("item is null").select("vec_id", F.col("vec_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                              F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
