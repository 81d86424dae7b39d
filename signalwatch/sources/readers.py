"""Readers of the reference-shaped CSV inputs (A1, A9) and of the register (A4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.functions.dates import parse_date_any
from signalwatch.session import path_exists
from signalwatch.sources import schemas


def _columns(raw: DataFrame, schema, optional=None) -> list:
    """Fields of the schema by header name (any order); a missing one is an error, an optional one may be absent."""
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"columns missing from the header: {', '.join(missing)}")
    return [*schema.fields, *(f for f in (optional.fields if optional else []) if f.name in raw.columns)]


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV as text under its own header; fully blank rows are dropped (a leading byte-order mark too)."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").option("encoding", "UTF-8").csv(path)
    first = df.columns[0]
    return df.withColumnRenamed(first, first.lstrip("\ufeff")).dropna(how="all")


def read_csv(spark: SparkSession, path: str, schema, optional=None) -> DataFrame:
    """The columns of ``schema``, found by header name and cast; text that is no such value becomes NULL
    (``unparsable`` counts those)."""
    raw = read_text(spark, path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in _columns(raw, schema, optional)])


def unparsable(spark: SparkSession, path: str, schema, dates=()) -> DataFrame:
    """One row: for each column of ``schema`` (text columns in ``dates`` as dates) the values that are no such value."""
    raw = read_text(spark, path)

    def bad(f):
        value = parse_date_any(f.name) if f.name in dates else F.col(f.name).try_cast(f.dataType)
        return F.count_if(F.col(f.name).isNotNull() & value.isNull()).alias(f.name)
    return raw.agg(*[bad(f) for f in _columns(raw, schema)])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, schemas.EVENTS_CSV)
    return df.withColumn("test_date", parse_date_any("test_date"))


def read_denoms(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, schemas.DENOMS_CSV)
    return df.withColumn("Period", parse_date_any("Period"))


def read_ref_rate(spark: SparkSession, path: str) -> DataFrame:
    """Rates by period, or by site and period where the file has a site column."""
    return read_csv(spark, path, schemas.REF_RATE_CSV, schemas.REF_RATE_OPTIONAL)


def read_provider_sites(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.PROVIDER_SITE_CSV)


def read_births(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.BIRTHS)


def read_site_mergers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.SITE_MERGERS)


def read_postcode_mapping(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.POSTCODE_MAPPING)


def read_table(spark: SparkSession, name: str, columns: dict[str, str]) -> DataFrame:
    """A2: an input that the catalog holds, by its name; its columns by theirs, cast to the types of ``columns``."""
    table = spark.read.table(name)
    missing = [c for c in columns if c not in table.columns]
    if missing:
        raise ValueError(f"table {name} lacks the columns {missing}")
    return table.select(*(F.col(c).cast(t).alias(c) for c, t in columns.items()))


def read_register(spark: SparkSession, base: str, run_date: _dt.date) -> DataFrame | None:
    """Newest register snapshot strictly before ``run_date`` (partition pruning on run_date).

    Returns None only when no register has been written (the path is missing); one
    that cannot be read is an error, else every signal would be notified again.
    Re-running on the same day reads the same earlier snapshot, so a re-run is idempotent.
    """
    if not path_exists(spark, base):
        return None
    reg = spark.read.parquet(base)
    before = reg.filter(F.col("run_date") < F.lit(run_date))
    latest = before.agg(F.max("run_date")).scalar()
    return before.filter(F.col("run_date") == latest).drop("run_date")
