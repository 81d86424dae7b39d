"""Merkle manifest of a dataset, with inclusion proofs by checkpoint and recompute.

Every row is a leaf: the hash of its fields, each marked by its length. The leaves of
a group (a language) ascend by id; every ``ARITY`` consecutive nodes become the hash
of their digests, level by level, until one is left, the group's subroot. The
subroots, ordered by group, give the root in the same way.

Only every ``STRIDE``-th level is written. The levels between are made twice and
kept nowhere: once on the way up, and once when proofs are extracted, where the
aligned subtree under each written node (at most ``ARITY ** STRIDE`` stored nodes)
makes its missing interior nodes again, gives each of its stored nodes the siblings
on the way to the subtree's top, and drops them. Proofs are handed down from the
root: a subtree adds its own part to the proof of its top.

How it runs: DataFrame functions only. Texts are read once, for the leaves; later
steps move digests. Places within a group come from a range sort (a tie number
spreads an id that repeats on many rows) and the counts of each sorted partition, so
a group that holds most rows is spread over all tasks. A subtree is the largest thing
in one task. Groups may be many: their subroots are one more tree, made alike. The
driver learns the height of the highest tree.

Defined cases: a null field is ``-``; an empty text is a field of no bytes; a null
group comes first, null ids before all others; rows that repeat an id stand by their
leaf hashes; equal rows are leaves of their own with equal hashes; a group of one
row has its leaf as subroot, one group alone has its subroot as root; an empty table
gives no rows; columns that are not fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.session import RunFolder

ARITY, STRIDE = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that a tree of 64-bit places can have.
MOST_LEVELS = 21


def leaf_hash(values: list[Column]) -> Column:
    """Hash of fields, each as its UTF-8 byte count, a colon and its text; a null is a dash."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""
    def step(node: Column, p: Column) -> Column:
        left, right = F.slice(p["siblings"], F.lit(1), p["place"]), F.slice(p["siblings"], p["place"] + 1, F.lit(ARITY))
        return F.sha2(F.concat(F.array_join(left, ""), node, F.array_join(right, "")), 256)
    return F.aggregate(proof, leaf, step)


def all_siblings(proof: Column) -> Column:
    """The digests of a proof, level by level and left to right, as one text."""
    return F.array_join(F.flatten(F.transform(proof, lambda p: p["siblings"])), "")


def above(nodes: Column) -> Column:
    """The next level of a run of nodes: one hash for each ARITY of them, the last for what is left."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(ARITY))
    return F.transform(starts, lambda k: F.sha2(F.array_join(F.slice(nodes, k, F.lit(ARITY)), ""), 256))


def placed(folder: RunFolder, rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (a written table) with ``at``, their place in their ``tree`` by ``order``, and the tree's ``height``."""
    by = ["tree", *order, "_tie"]
    rows = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = folder.keep(rows.drop("_tie").withColumn("_row", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_part", F.shiftright("_row", 33))
    runs = rows.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_here"))
    # a row for each sorted partition of a tree
    whole = Window.partitionBy("tree")
    before = F.sum("_here").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    n = F.sum("_here").over(whole)
    height = sum(((F.col("_n") > ARITY ** k).cast("int") for k in range(MOST_LEVELS)), F.lit(0))
    runs = runs.withColumns({"_before": F.coalesce(before, F.lit(0)), "_n": n}).withColumn("height", height)
    runs = folder.keep(runs.select("tree", "_part", "_first", "_before", "height"), f"{name}-runs")
    return (rows.join(runs, ["tree", "_part"]).withColumn("at", F.col("_before") + F.col("_row") - F.col("_first"))
            .drop("_part", "_row", "_first", "_before"))


def subtrees(rows: DataFrame, level: int, payload: tuple = ()) -> DataFrame:
    """The aligned subtrees over the stored nodes of a level, each with its interior levels ``v0`` to ``v2`` and its ``top``.

    A tree that ends within the stride stops at its subroot: the levels beyond are null.
    """
    rows = rows.filter(F.col("height") > level).withColumn("block", F.shiftright("at", 3 * STRIDE))
    out = rows.groupBy("tree", "block", "height").agg(F.array_sort(F.collect_list(F.struct("at", "node", *payload))).alias("members"))
    out = out.withColumn("steps", F.least(F.lit(STRIDE), F.col("height") - level))
    out = out.withColumn("v0", F.transform("members", lambda m: m["node"]))
    for s in range(1, STRIDE):
        out = out.withColumn(f"v{s}", F.when(F.col("steps") > s, above(F.col(f"v{s - 1}"))))
    last = F.coalesce(*(F.col(f"v{s}") for s in reversed(range(STRIDE))))
    return out.withColumn("top", F.element_at(above(last), 1))


def grown(folder: RunFolder, leaves: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees, the leaves first, and (tree, height, subroot) of every tree."""
    levels = [leaves]
    for level in range(0, most, STRIDE):
        rows = subtrees(levels[-1].select("tree", "height", "at", "node"), level)
        levels.append(folder.keep(rows.select("tree", "height", F.col("block").alias("at"), F.col("top").alias("node")), f"{name}-{level + STRIDE}"))
    tops = [rows.filter((F.col("height") <= k * STRIDE) & (F.col("height") > (k - 1) * STRIDE)) for k, rows in enumerate(levels)]
    found = tops[0].select("tree", "height", "node")
    for rows in tops[1:]:
        found = found.unionByName(rows.select("tree", "height", "node"))
    return levels, found.withColumnRenamed("node", "subroot")


def proven(levels: list[DataFrame], trees: DataFrame, most: int, payload: tuple) -> DataFrame:
    """Leaves (``node`` and ``payload``) with their proof up to the root.

    ``trees`` has the proof, subroot and root of each tree's top; a subtree's own siblings
    come before what its top was given.
    """
    given = ["proof", "subroot", "root"]
    down = None
    for level in reversed(range(0, most, STRIDE)):
        tops = trees.filter((F.col("height") > level) & (F.col("height") <= level + STRIDE)).select("tree", F.lit(0).cast("long").alias("block"), *given)
        down = tops if down is None else tops.unionByName(down.select("tree", F.col("at").alias("block"), *given))
        own = payload if level == 0 else ()
        blocks = subtrees(levels[level // STRIDE], level, own).join(down, ["tree", "block"])

        def part(m: Column, s: int) -> Column:
            place = F.shiftright(m["at"] - F.shiftleft(F.col("block"), 3 * STRIDE), 3 * s).cast("int")
            mine = F.pmod(place, F.lit(ARITY))
            run = F.slice(F.col(f"v{s}"), place - mine + 1, F.lit(ARITY))
            return F.struct(mine.alias("place"), F.filter(run, lambda _, k: k != mine).alias("siblings"))

        def with_proof(m: Column) -> Column:
            steps = F.slice(F.array(*(part(m, s) for s in range(STRIDE))), F.lit(1), F.col("steps"))
            return F.struct(m["at"].alias("at"), m["node"].alias("node"), *(m[c].alias(c) for c in own),
                            F.concat(steps, F.col("proof")).alias("proof"))

        rows = blocks.select("tree", "subroot", "root", F.explode(F.transform("members", with_proof)).alias("m"))
        down = rows.select("tree", "subroot", "root", "m.*")
    lone = levels[0].filter("height = 0").select("tree", "node", *payload).join(trees.select("tree", *given), "tree")
    return lone if down is None else down.select(lone.columns).unionByName(lone)


def manifest(docs: DataFrame, fields: tuple = FIELDS, group: str = "lang", key: str = "doc_id", carried: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root and proof, an array of (place in the run, the other
    digests of the run from left to right) from the leaf's level up to the root's. ``carried`` columns come along."""
    folder, carried = RunFolder(docs.sparkSession), carried or {}
    g = docs[group].cast("string")
    leaves = docs.select(F.when(g.isNull(), "").otherwise(F.concat(F.lit("="), g)).alias("tree"), docs[key].cast("long").alias("doc_id"),
                         leaf_hash([docs[c] for c in fields]).alias("node"), *(v.alias(c) for c, v in carried.items()))
    leaves = folder.keep(leaves, "hashed")
    payload = ("doc_id", *carried)
    leaves = placed(folder, leaves, ["doc_id", "node"], "leaves")
    most = leaves.agg(F.max("height")).first()[0] or 0
    levels, trees = grown(folder, leaves, most, "level")
    trees = folder.keep(trees, "trees")
    # the subroots are the leaves of one more tree
    upper = placed(folder, trees.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("height").alias("of_height"),
                                        F.col("subroot").alias("node")), ["of"], "subroots")
    upper_most = upper.agg(F.max("height")).first()[0] or 0
    upper_levels, top = grown(folder, upper, upper_most, "upper")
    nothing = F.array().cast("array<struct<place:int,siblings:array<string>>>")
    top = top.select("tree", "height", "subroot", F.col("subroot").alias("root"), nothing.alias("proof"))
    tops = proven(upper_levels, top, upper_most, ("of", "of_height"))
    tops = folder.keep(tops.select(F.col("of").alias("tree"), F.col("of_height").alias("height"), F.col("node").alias("subroot"), "root", "proof"), "proofs")
    rows = proven(levels, tops, most, payload)
    return rows.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", "proof", *carried)
