"""Births per site and month (J10) and the complete denominator table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.params import FLAG_STILLBIRTH


def births_by_month(current: DataFrame) -> DataFrame:
    """J10 in one pass: distinct babies and distinct stillborn babies per (site, trust, month).

    Two aggregation levels instead of two COUNT(DISTINCT)s and a join: first
    per baby (the shuffle key includes the baby, so one large site spreads over
    all reducers and duplicates are combined map-side), then per month on the
    already reduced rows.
    """
    is_sb = F.when(F.col("Deceased_Type_Flag") == FLAG_STILLBIRTH, 1).otherwise(0)
    per_baby = (current.groupBy("Site_Code", "ods_code", "Period", "Baby_ID")
                .agg(F.max(F.when(F.col("Baby_ID").isNull(), 0).otherwise(is_sb)).alias("sb")))
    return (per_baby.groupBy("Site_Code", "ods_code", "Period")
            .agg(F.count("Baby_ID").alias("Term_Births"), F.sum("sb").cast("long").alias("Term_Stillbirths")))


def live_births(monthly: DataFrame) -> DataFrame:
    """All_births: live = births - stillbirths."""
    return monthly.select("Site_Code", "Period", "Term_Births",
                          (F.col("Term_Births") - F.col("Term_Stillbirths")).alias("Term_Live_Births"))


def densify(df: DataFrame, row_key: str, col_key: str, fill: dict) -> DataFrame:
    """Every (row_key, col_key) combination, measures of missing combinations set by ``fill``.

    The distinct ``col_key`` values (months: as many as the calendar has) travel as
    one sorted array, computed by a scalar subquery; each row key explodes it.
    The output is exactly rows x columns, the size the result must have.
    """
    cols = df.agg(F.array_sort(F.collect_set(col_key))).scalar()
    keys = df.select(row_key).distinct()
    full = keys.select(row_key, F.explode(cols).alias(col_key))
    return full.join(df, [row_key, col_key], "left").fillna(fill)


def denoms_complete(all_births: DataFrame) -> DataFrame:
    """Complete site x period denominators with zeros and the year."""
    full = densify(all_births.select("Site_Code", "Period", "Term_Births", "Term_Live_Births"),
                   "Site_Code", "Period", {"Term_Births": 0, "Term_Live_Births": 0})
    return full.withColumn("Year", F.year("Period"))
