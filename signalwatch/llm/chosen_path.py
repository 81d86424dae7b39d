"""Jaccard join on word n-grams by chosen paths.

Every document is the set of its five-word shingles. A run splits the documents
recursively: a set goes down one branch for each of its tokens that the first
level's sampling hash picks (about ``branches`` of a set's tokens, so two similar
sets share a picked token with known probability); a branch with few sets is compared
by brute force, a larger one is split again by the token that the next level's hash
puts first (one, so that a large group of near copies does not fan out). Runs with
other hashes repeat until a pair at the threshold is met with probability
``recall``. Nothing is capped: branches still large at the last level are compared
in blocks against blocks.

1. One pass over the texts makes, for each document, the picked tokens of all runs
   and levels, a short sketch (the least hash of each of 128 bins) and a 128-bit
   hash of its set. Documents with equal sets are one class from here on, which goes
   by a number of its own; ids come back with the result.
2. Branch keys are counted with map-side combine; only keys with two classes or
   more go on. In a branch the sketches sort out pairs that are far apart (four
   standard deviations below the threshold); what remains is a few small groups.
3. Only classes in such groups fetch their text again; their exact sets are
   compared and each group gives a spanning forest of its links, never its pairs.
4. Components of the forest by alternating large and small stars.
5. The exact number of links: the classes of a component are compared all against
   all in bounded blocks, which give a number for each class, never a pair.

Defined cases: a text with fewer than five words is one shingle, its words; a text
without words and a row with a null id link with nothing; equal texts are one class
and link with each other; an id may hold several texts, each of which is compared on
its own; every row of the input gives one row; other columns are ignored. Ties on ids
go to the smallest.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import worker_cache
from signalwatch.llm.links import Store, components, grouped, groups_of, join_unique

#: Tokens that a set picks on the first level, on average, and levels of a run.
BRANCHES, LEVELS = 3.0, 3
#: Classes in a branch that are compared at once; a larger one is split again.
SMALL = 2048
#: Shingles that a group of exact sets may hold (and SMALL classes); a larger one is compared in blocks.
GROUP_SHINGLES = 1_000_000
BINS = 128
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHash(dict):
    """Word -> 64-bit hash; starts anew when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word windows of a text (words lower-case in A-Z, cut at ASCII white space)."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = worker_cache("word hashes", WordHash)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(len(h) - width + 1, 1)
    out = np.full(n, min(len(h), width), np.uint64)
    for k in range(min(width, len(h))):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n])
    return np.unique(out)


def sketch(s: np.ndarray) -> np.ndarray:
    """16 bits of the least element of each bin of a sorted set; 0 where the bin is empty."""
    edge = np.arange(BINS, dtype=np.uint64) << np.uint64(57)
    at = np.searchsorted(s, edge)
    end = np.append(at[1:], len(s))
    return np.where(at < end, (s[np.minimum(at, len(s) - 1)] & np.uint64(0xFFFF)) | np.uint64(1), 0).astype(np.uint16)


def set_hash(s: np.ndarray) -> int:
    """64 bits of a sorted set as a signed number, the second half by another seed."""
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).astype(np.int64))


def picked(s: np.ndarray, runs: int, branches: float = BRANCHES, levels: int = LEVELS) -> list[list[list[int]]]:
    """For each run, the tokens of the set whose first-level hash is small, then the token of least hash on each level."""
    rng = np.random.default_rng(20_240_607)
    out = []
    most = 2.0 ** 64 * branches / len(s)
    limit = np.uint64(min(most, 2.0 ** 64 - 2049))
    for _ in range(runs):
        run = []
        for level in range(levels):
            a, m = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            h = (s ^ a) * (m | np.uint64(1))
            hit = s[h.argmin():][:1] if level else s if most >= 2.0 ** 64 else s[h <= limit]
            run.append(hit.astype(np.int64).tolist())
        out.append(run)
    return out


def runs_needed(threshold: float, recall: float, branches: float = BRANCHES, levels: int = LEVELS) -> int:
    """Runs until a pair at the threshold shares a path with probability ``recall``.

    The worse of two such pairs (equal sizes, or one inside the other) shares a Poisson
    number of tokens picked on the first level, and the token of least hash with the
    pair's similarity; a run finds it for sure if it shares one on every level. Most
    pairs meet in a branch that is small before the last level.
    """
    mean = branches * min(2 * threshold / (1 + threshold), threshold)
    found = (1 - math.exp(-mean)) * threshold ** (levels - 1)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def close_in_sketch(sk: np.ndarray, n: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs may reach the threshold: sizes allow it and the sketches agree within four standard deviations."""
    m = len(n)
    full, ok = sk > 0, np.zeros((m, m), bool)
    for lo in range(0, m, 128):  # rows against all, to hold no more than a few slim matrices
        a, f, size = sk[lo:lo + 128], full[lo:lo + 128], n[lo:lo + 128, None]
        if m <= 48:
            same = ((a[:, None] == sk[None]) & f[:, None]).sum(2)
            either = (f[:, None] | full[None]).sum(2)
        else:
            same, either = np.zeros((len(a), m), np.int16), np.zeros((len(a), m), np.int16)
            for b in range(BINS):
                same += (a[:, b, None] == sk[None, :, b]) & f[:, b, None]
                either += f[:, b, None] | full[None, :, b]
        least = threshold - 4 * np.sqrt(threshold * (1 - threshold) / np.maximum(either, 1))
        sizes_allow = np.minimum(size, n[None]) >= threshold * np.maximum(size, n[None]) - 1e-9
        ok[lo:lo + 128] = (same >= least * either) & sizes_allow
    np.fill_diagonal(ok, False)
    return ok


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by counting over the shared elements in bounded slices."""
    m = len(sets)
    flat, row = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    _, col, times = np.unique(flat, return_inverse=True, return_counts=True)
    keep = times[col] > 1
    row, col = row[keep], col[keep]
    names, col = np.unique(col, return_inverse=True)
    total = np.zeros((m, m), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    slice_width = max(256, 4_000_000 // max(m, 1))
    for lo in range(0, len(names), slice_width):
        a, b = np.searchsorted(col, [lo, lo + slice_width])
        x = np.zeros((m, min(slice_width, len(names) - lo)), np.float32)
        x[row[a:b], col[a:b] - lo] = 1
        total += x @ x.T
    return total


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of at least the threshold."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        yes = both >= threshold * (len(sets[0]) + len(sets[1]) - both) - 1e-9
        return np.array([[False, yes], [yes, False]])
    both = intersections(sets)
    n = np.array([len(s) for s in sets], np.float32)
    ok = both >= threshold * (n[:, None] + n[None] - both) - 1e-3
    np.fill_diagonal(ok, False)
    return ok


def signatures(docs: DataFrame, runs: int, width: int, key: str, text: str) -> DataFrame:
    """doc_id, hash of the text, number of shingles, set hash, sketch and picked tokens of each row."""
    rows = docs.select(docs[key].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"),
                       F.xxhash64(docs[text]).alias("text_hash"))

    def run(batches):
        names = ["doc_id", "text_hash", "n", "h1", "h2", "sketch", "paths"]
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.list_(pa.list_(pa.list_(pa.int64())))]
        for b in batches:
            for lo in range(0, len(b), 500):
                part, out = b.slice(lo, 500), []
                for i, t, th in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist()):
                    s = shingles(t.as_py(), width)
                    if i is None or not len(s):
                        out.append((i, th, 0, 0, 0, b"", []))
                    else:
                        out.append((i, th, len(s), set_hash(s), set_hash(s[::-1]), sketch(s).tobytes(), picked(s, runs)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return rows.mapInArrow(run, "doc_id long, text_hash long, n long, h1 long, h2 long, sketch binary, paths array<array<array<long>>>")


def branches_of(store: Store, classes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(branch, class) of every branch with two classes or more, split until it is small."""
    small = SMALL
    rows = classes.select("class", F.posexplode("paths").alias("run", "path")).select(
        "class", "path", F.explode(F.col("path")[0]).alias("token"), F.xxhash64("run").alias("branch"))
    leaves = []
    for level in range(levels):
        rows = rows.select("class", "path", F.xxhash64("branch", "token").alias("branch"))
        many = rows.groupBy("branch").agg(F.count("*").alias("size")).filter("size > 1")
        kept = store.keep(rows.join(many, "branch"), f"level{level}")
        leaves.append(kept.filter(F.col("size") <= small).select("branch", "class"))
        large = kept.filter(F.col("size") > small)
        if level == levels - 1:
            parts = F.ceil(F.col("size") / (small // 2)).cast("int")
            mine = F.pmod(F.xxhash64("class", F.lit(3)), parts).cast("int")
            pairs = large.select("class", "branch", mine.alias("a"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("b"))
            leaves.append(pairs.select(F.xxhash64("branch", F.least("a", "b"), F.greatest("a", "b")).alias("branch"), "class"))
        else:
            rows = large.select("class", "path", "branch", F.explode(F.col("path")[level + 1]).alias("token"))
    out = leaves[0]
    for x in leaves[1:]:
        out = out.unionByName(x)
    return out.distinct()


def sketch_groups(branches: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(group, class): classes that the sketches of a branch connect; large groups as blocks against blocks."""
    rows = (branches.join(classes.select("class", "n", "sketch"), "class").select("branch", "class", "n", "sketch")
            .repartition("branch").sortWithinPartitions("branch"))

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, members in grouped(batches, 4):
            members.sort()
            ids = np.array([m[0] for m in members], np.int64)
            n = np.array([m[1] for m in members], np.int64)
            sk = np.frombuffer(b"".join(m[2] for m in members), np.uint16).reshape(-1, BINS)
            for g in groups_of(close_in_sketch(sk, n, threshold)):
                parts = int(-(-n[g].sum() // (GROUP_SHINGLES // 2))) if n[g].sum() > GROUP_SHINGLES else 1
                mine = np.arange(len(g)) % parts
                for a in range(parts):
                    for b in range(a, parts):
                        k = ids[g[(mine == a) | (mine == b)]]
                        name = set_hash(k)
                        out += [(name, x) for x in k.tolist()]
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["group", "class"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["group", "class"])

    return rows.mapInArrow(run, "group long, class long").distinct()


def exact_sets(docs: DataFrame, groups: DataFrame, classes: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """class, copies and exact set of every class in a group; the only step that moves texts."""
    want = groups.select("class").distinct().join(classes.select("class", "least", "text_hash", "h1", "copies"), "class")
    rows = docs.select(docs[key].cast("long").alias("least"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("text_hash"))
    rows = rows.filter("text is not null").join(want, ["least", "text_hash"]).select("class", "copies", "h1", "text")

    def run(batches):
        for b in batches:
            for lo in range(0, len(b), 200):
                part, out = b.slice(lo, 200), []
                for c, n, h, t in zip(*(part.column(k).to_pylist() for k in range(4))):
                    s = shingles(t, width)
                    if len(s) and set_hash(s) == h:  # another text of the same id and hash is not this class
                        out.append((c, n, s.tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))],
                                                     ["class", "copies", "items"])

    return rows.mapInArrow(run, "class long, copies long, items binary").dropDuplicates(["class"])


def spanning_links(groups: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): for each group a spanning forest of its exact links, every class tied to the least of its tree."""
    rows = (groups.join(sets.select("class", "items"), "class").select("group", "class", "items")
            .repartition("group").sortWithinPartitions("group"))

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, members in grouped(batches, 3):
            members.sort(key=lambda m: m[0])
            if len(members) > 1:
                ok = linked([np.frombuffer(m[1], np.uint64) for m in members], threshold)
                for g in groups_of(ok):
                    out += [(members[g[0]][0], members[k][0]) for k in g[1:].tolist()]
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def link_counts(sets: DataFrame, roots: DataFrame, threshold: float, store: Store | None = None) -> DataFrame:
    """(class, links): documents of other classes linked directly with each class, within its component."""
    store = store or Store(sets.sparkSession, "link-counts")
    narrow = sets.select(F.col("class").alias("node"), (F.length("items") / 8).alias("shingles")).join(roots, "node")
    narrow = store.keep(narrow, "sizes")
    size = store.keep(narrow.groupBy("root").agg(F.sum("shingles").alias("size"), F.count("*").alias("in_root")), "roots-sizes")
    fits = (F.col("size") <= GROUP_SHINGLES) & (F.col("in_root") <= SMALL)  # the matrices of a task grow with its classes
    parts = F.greatest(F.ceil(F.col("size") / (GROUP_SHINGLES // 2)), F.ceil(F.col("in_root") / (SMALL // 2))).cast("int")
    dealt = join_unique(narrow.select("node", "root"), size, ["root"], "in_root")  # the payload comes after
    dealt = dealt.select("root", F.col("node").alias("class"), F.when(fits, F.lit(1)).otherwise(parts).alias("parts"))
    rows = dealt.join(sets, "class")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("class", F.lit(5)), "parts").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(F.xxhash64("root", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"),
                       (F.col("mine") != F.col("other")).alias("across"), (F.col("mine") < F.col("other")).alias("low"),
                       "class", "copies", "items").repartition("task").sortWithinPartitions("task")

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, members in grouped(batches, 6):
            across, low, ids, copies, items = zip(*members)
            if len(ids) > 1:
                ok = linked([np.frombuffer(x, np.uint64) for x in items], threshold)
                if across[0]:  # block against block: only pairs across; pairs inside are counted by the block itself
                    side = np.array(low)
                    ok &= side[:, None] != side[None]
                out += zip(ids, (ok @ np.array(copies, np.int64)).tolist())
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["class", "links"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["class", "links"])

    return rows.mapInArrow(run, "class long, links long").groupBy("class").agg(F.sum("links").alias("links"))


def joined(docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.999, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """The rows of ``join`` and, as ``first``, whether a row is the one of its component to keep: unlinked, or of the least
    id and, where that id has several texts in the component, of the least text hash."""
    store = Store(docs.sparkSession, "chosen-path")
    runs = runs_needed(threshold, recall)
    sig = signatures(docs, runs, width, key, text).withColumn("row", F.monotonically_increasing_id())
    sig = store.keep(sig, "signatures")  # written, so the number of a row stays
    same = ["h1", "h2", "n"]
    real = sig.filter("n > 0").select("doc_id", "text_hash", "row", *same)
    found = real.groupBy(*same).agg(F.min(F.struct("doc_id", "text_hash", "row")).alias("f"), F.count("*").alias("copies"))
    # a class goes by the number of its least row; only that row's sketch and paths are moved, and once
    found = store.keep(found.select(*same, F.col("f.doc_id").alias("least"), F.col("f.text_hash").alias("text_hash"), "copies",
                                    F.col("f.row").alias("class")), "classes")
    classes = sig.select(F.col("row").alias("class"), "sketch", "paths").join(found.select("class", "n"), "class")
    classes = store.keep(classes, "representatives")
    groups = store.keep(sketch_groups(branches_of(store, classes), classes, threshold), "groups")
    sets = store.keep(exact_sets(docs, groups, found, width, key, text), "sets")
    roots = store.keep(components(store, spanning_links(groups, sets, threshold)), "roots")
    links = store.keep(link_counts(sets, roots, threshold, store), "links")
    in_root = store.keep(found.join(roots, found["class"] == roots["node"]).groupBy("root").agg(
        F.min(F.struct("least", "text_hash")).alias("first_of"), F.count("*").alias("in_root")), "firsts")
    tied = join_unique(roots, in_root, ["root"], "in_root").select(F.col("node").alias("class"), "first_of")
    of_class = (found.join(tied, "class", "left").join(links, "class", "left")
                .select(*same, "copies", "least", F.coalesce("first_of.least", "least").alias("component_id"),
                        F.coalesce("first_of.text_hash", "text_hash").alias("first_hash"),
                        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    of_class = store.keep(of_class, "of-class")
    kept = F.col("doc_id") == F.col("component_id")
    linked_rows = join_unique(real.drop("row"), of_class, same, "copies").select(
        "doc_id", "text_hash", F.col("least").alias("class_id"), "component_id", "n_links", kept.alias("kept"),
        (kept & F.coalesce(F.col("text_hash") == F.col("first_hash"), F.lit(True))).alias("first"))
    alone = sig.filter("n = 0").select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"),
                                       F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"), F.lit(True).alias("first"))
    return linked_rows.unionByName(alone)


def join(docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.999, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (least id with an equal set), component_id (least id reachable
    by links), n_links (other documents linked directly) and kept (doc_id = component_id; always for unlinked rows);
    text_hash tells rows of a repeated id apart."""
    return joined(docs, threshold, width, recall, key, text).drop("first")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, without all but the first (least id) of each group of linked documents.

    Of several linked texts of that id, and of rows that repeat both id and text, one stays; rows with a null id all stay.
    """
    found = joined(docs, key=key, text=text, **options)
    at, text_hash, nth = (f"_{uuid.uuid4().hex}" for _ in range(3))  # no column of the table has these names
    gone = found.filter("not first").select(F.col("doc_id").alias(at), F.col("text_hash").alias(text_hash)).distinct()
    named = docs.filter(docs[key].isNotNull())
    named = named.withColumns({at: named[key].cast("long"), text_hash: F.xxhash64(named[text])})
    named = named.join(gone, [at, text_hash], "left_anti")
    first = F.row_number().over(Window.partitionBy(at, text_hash).orderBy(at))
    named = named.withColumn(nth, first).filter(F.col(nth) == 1).select(*docs.columns)
    return named.unionByName(docs.filter(docs[key].isNull()))
