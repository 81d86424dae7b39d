"""The Merkle manifest against a plain tree."""

from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from signalwatch.llm import merkle

from .conftest import CLASHES, ODD

FIELDS = ("doc_id", "lang", "text")


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(values) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def siblings(tree: list[list[str]], at: int) -> list[str]:
    out = []
    for row in tree[:-1]:
        first = at // 8 * 8
        out += [x for k, x in enumerate(row[first:first + 8], first) if k != at]
        at //= 8
    return out


def plain(rows):
    """rows: (id, group, other fields...) -> sorted (id, leaf, subroot, root, all siblings)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0], leaf(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x for _, x in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, (i, x) in enumerate(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))):
            out.append((i, x, trees[g][-1][0], top[-1][0], "".join(siblings(trees[g], at) + siblings(top, k))))
    return sorted(out, key=repr)


def got(df):
    rows = df.select("doc_id", "leaf", "subroot", "root", merkle.all_siblings(F.col("proof")).alias("s"),
                     (merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok")).collect()
    assert all(r.ok for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=repr)


def test_odd_rows_and_clashing_names(odd, nothing):
    rows = [(i, None if k % 3 else "en", t) for k, (i, t) in enumerate(ODD)]
    extra = odd.withColumns({c: F.lit("x") for c in ("tree", "at", "node", "height", "block", "members", "proof", "leaf", "_tie", "_row")})
    assert got(merkle.manifest(extra, FIELDS)) == plain(rows) and set(CLASHES) < set(extra.columns)
    assert merkle.manifest(nothing, FIELDS).count() == 0


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (8, 9, 1), (65, 64, 513, 7), tuple([1] * 70) + (600,)])
def test_heights_of_groups(spark, sizes):
    """One leaf, full runs, a last run of one, several strides, and more groups than one stride holds."""
    rows = [(i, f"g{g}é" if g else None, f"text {i}") for g, n in enumerate(sizes) for i in range(n)]
    assert got(merkle.manifest(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5), FIELDS)) == plain(rows)


def test_an_id_on_most_rows(spark):
    rows = [(7, "en", f"t{k % 3}") for k in range(700)] + [(k, "en", "x") for k in range(20)]
    assert got(merkle.manifest(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(6), FIELDS)) == plain(rows)


def test_a_changed_leaf_does_not_verify(spark):
    rows = [(k, "en", f"Text {k}") for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    lowered = merkle.leaf_hash([F.col("doc_id"), F.col("lang"), F.lower("text")])
    m = merkle.manifest(df, FIELDS, carried={"other": lowered}).select((merkle.folded(F.col("other"), F.col("proof")) == F.col("root")).alias("ok"))
    assert m.filter("ok").count() == 0
