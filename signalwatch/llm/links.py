"""Helpers of the operators that link rows: stored steps, groups of links, connected components."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.session import ensure_checkpoint_dir


class Store:
    """Intermediate tables in the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back; Arrow batches are small meanwhile, as rows may hold whole sets."""
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "500")
        try:
            df.write.parquet(f"{self.base}/{name}")
        finally:
            self.spark.conf.set(setting, before)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}")


def groups_of(ok: np.ndarray) -> list[np.ndarray]:
    """Connected groups of two or more of a symmetric yes/no matrix."""
    out, seen = [], ~ok.any(1)
    for k in range(len(ok)):
        if not seen[k]:
            group = edge = np.zeros(len(ok), bool)
            group[k] = edge[k] = True
            while edge.any():
                edge = ok[edge].any(0) & ~group
                group = group | edge
            seen |= group
            out.append(np.flatnonzero(group))
    return out


def grouped(batches, columns: int):
    """Rows of sorted Arrow batches group by group (the first column); a group is held whole, so it must be bounded."""
    key, rows = None, []
    for b in batches:
        for r in zip(*(b.column(k).to_pylist() for k in range(columns))):
            if r[0] != key and rows:
                yield key, rows
                rows = []
            key = r[0]
            rows.append(r[1:])
    if rows:
        yield key, rows


def join_unique(rows: DataFrame, unique: DataFrame, on: list[str], uses: str) -> DataFrame:
    """``rows`` joined with ``unique``, which has one row for each key of theirs and, as ``uses``, how many of them have it.

    Keys of more than a thousandth of the rows, a thousand of them at most, are sent to all tasks and their rows
    stay where they are; no other key has more rows than that in one place. ``unique`` is narrow and a written table.
    """
    total = unique.agg(F.coalesce(F.sum(uses), F.lit(0)).alias("n")).first()["n"]
    often = F.col(uses) * 1000 > total
    hot = unique.filter(often)
    many = rows.join(F.broadcast(hot), on)  # fewer than 1,000 rows
    few = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(unique.filter(~often), on)
    return many.unionByName(few)


def components(store: Store, edges: DataFrame, name: str = "star") -> DataFrame:
    """(node, root): the least node of each component, by alternating large and small stars until nothing moves."""
    now, turn = store.keep(edges.select("a", "b"), f"{name}0"), 0
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        # small star: a node and its smaller neighbours all go to the least of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(low, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
                 .filter("a < b").distinct())
        turn += 1
        after = store.keep(small, f"{name}{turn}")
        if now.exceptAll(after).isEmpty() and after.exceptAll(now).isEmpty():
            break
        now = after
    found = now.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
