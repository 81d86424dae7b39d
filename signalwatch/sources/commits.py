"""Outputs of a run that become visible together.

A run writes each output to a folder of its own; a one-row file in ``commits``, put
there by one rename at the end, makes the run known. Readers go through that
log, so they see all outputs of a run or none, also while it runs and after it was
stopped halfway; nothing is overwritten in place. Folders of runs without a commit
are left for the caller to clean.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from signalwatch.session import path_exists

COMMIT = "run_date date, at timestamp, run string, outputs array<string>"


class RunLog:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def path(self, run: str, name: str) -> str:
        return os.path.join(self.base, "runs", run, name)

    def start(self, run_date: dt.date) -> str:
        """A name for a new run; nothing is written yet."""
        return f"{run_date.isoformat()}-{uuid.uuid4().hex[:12]}"

    def commit(self, run: str, run_date: dt.date, outputs: list[str]) -> None:
        """Make a run known once all its outputs are written."""
        missing = [n for n in outputs if not path_exists(self.spark, os.path.join(self.path(run, n), "_SUCCESS"))]
        if missing:
            raise ValueError(f"outputs not finished: {', '.join(missing)}")
        row = self.spark.createDataFrame([(run_date, dt.datetime.now(dt.timezone.utc), run, outputs)], COMMIT)
        row.coalesce(1).write.mode("append").parquet(os.path.join(self.base, "commits"))

    def runs(self) -> DataFrame:
        """The known runs; a second run of one date replaces the first, as the later one of it is read."""
        path = os.path.join(self.base, "commits")
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).parquet(path)

    def newest(self, before: dt.date | None = None) -> Row | None:
        """The last known run (of an earlier date); one row of the log."""
        runs = self.runs()
        if before:
            runs = runs.filter(F.col("run_date") < F.lit(before))
        return runs.agg(F.max(F.struct("run_date", "at", "run", "outputs")).alias("c")).first()["c"]

    def read(self, name: str, before: dt.date | None = None) -> DataFrame | None:
        """An output of the newest known run (of an earlier date); None where there is no such run."""
        found = self.newest(before)
        if found is None:
            return None
        if name not in found["outputs"]:
            raise ValueError(f"run {found['run']} has no output {name}")
        return self.spark.read.parquet(self.path(found["run"], name))
