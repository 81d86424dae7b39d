"""Sinks (A5-A8, L27): CSV and parquet outputs, dated snapshots and the register history."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, UTF-8, replacing what was there.

    Multi-part output by default; ``single_file`` funnels the rows through one
    writer task and is meant for small reports that a person opens.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """A table of the catalog, replaced as a whole; with ``path`` its files lie there."""
    out = df.write.mode("overwrite")
    (out.option("path", path) if path else out).saveAsTable(name)


def write_dated(df: DataFrame, base: str, run_date: _dt.date, fmt: str = "parquet") -> None:
    """Snapshot under ``base/run_date=YYYY-MM-DD``; only that day's partition is replaced.

    A re-run on the same day overwrites its own snapshot and leaves every
    other day untouched (dynamic partition overwrite).
    """
    (df.withColumn("run_date", F.lit(run_date))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("header", True).partitionBy("run_date").format(fmt).save(base))


def write_register(new_register: DataFrame, base: str, run_date: _dt.date) -> None:
    """The register for the next run, kept as a run-date partitioned history.

    ``sources.readers.read_register`` reads the newest partition before a run
    date, so comparing never sees its own run's signals.
    """
    write_dated(new_register.select("ID", "Site_Code", "Site_Name", "ODS_Code", "ODS_Name", "Date_Email"),
                base, run_date)
