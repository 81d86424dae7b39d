"""Incremental refresh: a run continues each site from the last run's state.

The state holds, for each site, the last closed month, the unrounded CUSUM
statistic and the running excess at its end, and a fingerprint of every input up
to it. A run computes the fingerprint of the new extract up to the same month; where
it is equal, the fold and the daily line go on from the state and only later
months get rows; where it differs (late or changed events, another rate, denominator
or threshold), and for new sites, the whole series is made again.

What a run writes, under its date: the chart and the daily line of the months it
computed, then the state. The state is written last and readers only take runs that
have one, so a run that stops halfway is not seen. A month is closed once
``open_months`` later ones may still change; rows of open months are made anew by
each run. Sums and folds take the same steps as over the whole series, so the
result is that of a full run.

Defined cases: without a state all sites start anew; a site that has left the extract
loses its rows; a second run of one date replaces the first; runs go forward in time.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.operators import cusum, lines, vlad
from signalwatch.session import RunFolder, path_exists
from signalwatch.sources.sinks import write_dated

MONTH_INPUTS = ["year_month", "numerator", "Ref_Rate", "denominator", "k", "h_L1", "h_L2"]
DAY_INPUTS = ["test_date", "daily_count", "Event_Type"]
STATE_COLS = ["Site_Code", "upto", "statistic", "excess", "since", "n", "mark"]


def _hash(kind: str, cols: list[str]):
    return F.xxhash64(F.lit(kind), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols])


def _month(day: str):
    return F.date_format(day, "yyyy-MM")


def fingerprints(months: DataFrame, daily: DataFrame, upto: DataFrame) -> DataFrame:
    """(Site_Code, n, mark): number and combined hash of a site's input rows up to its month in ``upto``."""
    rows = months.select("Site_Code", F.col("year_month").alias("_m"), _hash("month", MONTH_INPUTS).alias("_h")).unionByName(
        daily.select("Site_Code", _month("test_date").alias("_m"), _hash("day", DAY_INPUTS).alias("_h")))
    rows = rows.join(upto.select("Site_Code", "upto"), "Site_Code").filter(F.col("_m") <= F.col("upto"))
    return rows.groupBy("Site_Code").agg(F.count("*").alias("n"), F.bit_xor("_h").alias("mark"))


def unchanged(months: DataFrame, daily: DataFrame, state: DataFrame) -> DataFrame:
    """The rows of ``state`` whose site has the same inputs up to its month as when it was written."""
    return state.join(fingerprints(months, daily, state), ["Site_Code", "n", "mark"]).select(*STATE_COLS)


def chart_after(months: DataFrame, kept: DataFrame, run_date: dt.date) -> DataFrame:
    """The chart of the months after each kept site's state, of all months of other sites; with ``_S`` and ``_x0``
    (unrounded statistic, running excess before the first row) and ``since``, the run that began the series."""
    go_on = kept.select("Site_Code", "upto", F.coalesce("statistic", F.lit(0.0)).alias("_s0"), "excess", "since")
    todo = months.join(go_on, "Site_Code", "left").filter(F.col("upto").isNull() | (F.col("year_month") > F.col("upto")))
    todo = todo.withColumns({"_x0": F.when(F.col("upto").isNull(), F.lit(0.0)).otherwise(F.col("excess")),
                             "since": F.coalesce("since", F.lit(run_date))}).drop("upto", "excess")
    return lines.chart_dates(lines.signal_level(cusum.cusum_reset(todo, start="_s0", raw="_S"))).drop("_s0")


def _line_inputs(chart: DataFrame, daily: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """The chart's months, the events after each kept site's state, and the column with the excess to go on from."""
    later = daily.join(kept.select("Site_Code", "upto"), "Site_Code", "left")
    later = later.filter(F.col("upto").isNull() | (_month("test_date") > F.col("upto"))).drop("upto")
    return chart.withColumnRenamed("Cusum_Period", "Date"), later, "_x0"


def line_after(chart: DataFrame, daily: DataFrame, kept: DataFrame) -> DataFrame:
    """The daily line of the chart's months, running on from each site's excess."""
    return vlad.vlad(*_line_inputs(chart, daily, kept))


def state_after(chart: DataFrame, kept: DataFrame, months: DataFrame, daily: DataFrame) -> DataFrame:
    """The state at the end of the closed months: the last of the new ones, or the kept one where there is none.
    The excess comes from the months, as the line's does, so the line is not read for it."""
    last = chart.filter("closed").groupBy("Site_Code").agg(F.max(F.struct("year_month", "_S", "since")).alias("c"))
    total = (vlad.month_ends(*_line_inputs(chart.filter("closed"), daily, kept)).groupBy("Site_Code")
             .agg(F.max(F.struct("Date_VLAD", "cmltv_excess_events")).alias("d")))
    new = last.join(total, "Site_Code").select(
        "Site_Code", F.col("c.year_month").alias("upto"), F.col("c._S").alias("statistic"),
        F.col("d.cmltv_excess_events").alias("excess"), F.col("c.since").alias("since"))
    old = kept.select(*new.columns).join(new.select("Site_Code"), "Site_Code", "left_anti")
    state = new.unionByName(old)
    return state.join(fingerprints(months, daily, state), "Site_Code").select(*STATE_COLS)


def _newest(spark: SparkSession, base: str, before: dt.date | None) -> tuple[DataFrame | None, dt.date | None]:
    """The newest state (before a date) and its run date."""
    path = os.path.join(base, "state")
    if not path_exists(spark, path):
        return None, None
    states = spark.read.parquet(path)
    if before:
        states = states.filter(F.col("run_date") < F.lit(before))
    day = states.agg(F.max("run_date")).first()[0]
    return (states.filter(F.col("run_date") == F.lit(day)), day) if day else (None, None)


def refresh(months: DataFrame, daily: DataFrame, base: str, run_date: dt.date, open_months: int = 1) -> None:
    """One run: ``months`` is the month grid with thresholds, ``daily`` the events by day, both of the whole extract
    (written tables, as they are read more than once); chart, line and state go to ``base`` under the run's date."""
    spark = months.sparkSession
    state, _ = _newest(spark, base, run_date)
    folder = RunFolder(spark)
    if state is None:
        kept = spark.createDataFrame([], "Site_Code string, upto string, statistic double, excess double, since date, n long, mark long")
    else:  # a row per site, read by all that follows
        kept = folder.keep(unchanged(months, daily, state), "kept")
    newest = months.agg(F.max("year_month")).scalar()
    closed = F.date_format(F.add_months(F.to_date(F.concat(newest, F.lit("-01"))), -open_months), "yyyy-MM")
    chart = chart_after(months, kept, run_date)
    write_dated(chart.withColumn("closed", F.col("year_month") <= closed), os.path.join(base, "chart"), run_date)
    here = F.col("run_date") == F.lit(run_date)
    # a number of its own: the months are few bytes and would be read by few tasks, which make thirty days of each
    chart = spark.read.parquet(os.path.join(base, "chart")).filter(here).drop("run_date").repartition(folder.buckets, "Site_Code")
    line = line_after(chart, daily, kept).withColumn("closed", F.col("Date_VLAD") <= F.last_day(F.to_date(F.concat(closed, F.lit("-01")))))
    write_dated(line, os.path.join(base, "line"), run_date)
    write_dated(state_after(chart, kept, months, daily), os.path.join(base, "state"), run_date)
    folder.remove()


def current_state(spark: SparkSession, base: str) -> DataFrame:
    """The newest run's state."""
    return _newest(spark, base, None)[0]


def current(spark: SparkSession, base: str, name: str) -> DataFrame:
    """All valid rows of ``name`` (chart or line): those of the newest run, and the closed months that earlier runs
    wrote for sites whose series they began or continued. The sites, one narrow row each, go to the old rows; these,
    thirty for each month, are not dealt out for them."""
    state, day = _newest(spark, base, None)
    if state is None:
        raise ValueError(f"no finished run in {base}")
    rows = spark.read.parquet(os.path.join(base, name)).filter(F.col("run_date") <= F.lit(day))
    new = rows.filter(F.col("run_date") == F.lit(day))
    old = rows.filter("closed").filter(F.col("run_date") < F.lit(day))
    began = state.select("Site_Code", F.col("since").alias("_since"))
    old = old.join(F.broadcast(began), "Site_Code").filter(F.col("run_date") >= F.col("_since")).drop("_since")
    return new.unionByName(old.select(*new.columns)).drop("closed", "run_date", "since", "_S", "_x0")
