"""Session helpers: configuration for local tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "signalwatch",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster use the cluster's own session."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only a local session without one gets a fresh scratch
    folder (tests, bench). A cluster session without it is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="signalwatch-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def figures(watch: Observation) -> dict | None:
    """What an Observation has seen; None where the optimizer found the watched rows to be none and left the watch out."""
    try:
        return watch.get or None
    except Py4JJavaError as e:  # such a row has no schema, which the conversion asserts
        if "AssertionError" not in str(e):
            raise
        return None


class RunFolder:
    """The intermediate tables of one run: a folder of its own under the shared checkpoint folder.

    A table is written as parquet and read back. That cuts the lineage, so a lost
    executor costs one re-read and not a rerun of the whole chain, and lets several
    outputs share one computation. Parquet rather than ``checkpoint()``: the planner
    then sees the real file sizes. ``remove()`` deletes the folder at the end of a run.

    A table may be bucketed by a column: its readers then join, group and window by that
    column without a shuffle. Figures may be watched while a table is written; they
    come from that job and end up in ``seen``.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = f"run_{uuid.uuid4().hex}"
        self.path = os.path.join(ensure_checkpoint_dir(spark), self.name)
        self.seen: dict[str, object] = {}
        self.tables: list[str] = []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keep(self, df: DataFrame, name: str, watched: dict[str, Column] | None = None, by: str | None = None) -> DataFrame:
        path = os.path.join(self.path, name)
        watch = Observation(f"{self.name}_{name}")
        if by:  # before the watch, so that this stays the last step
            df = df.repartition(self.buckets, by)
        if watched:
            df = df.observe(watch, *(c.alias(k) for k, c in watched.items()))
        if by:
            table = f"{self.name}_{name}"
            df.write.mode("overwrite").bucketBy(self.buckets, by).sortBy(by).option("path", path).saveAsTable(table)
            self.tables.append(table)
        else:
            df.write.mode("overwrite").parquet(path)
        kept = self.spark.table(table) if by else self.spark.read.parquet(path)
        if watched:
            got = figures(watch)
            if got is None and not kept.isEmpty():
                raise RuntimeError(f"the figures of {name} were not watched")
            self.seen |= {k: (got or {}).get(k) for k in watched}
        return kept

    def remove(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
