"""Signal levels, chart rows, tooltips, recency flags, reset and threshold rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.functions.dates import month_label, month_start, months_apart, third_last_day
from signalwatch.functions.labels import outcome_label
from signalwatch.functions.text import sorted_join
from signalwatch.params import MONTH_LABELS

FLAG_COLS = ["Level1_6months", "Level2_6months", "Level1_12months", "Level2_12months"]
LINE_COLS = ["Date", "Date_of_signal", "Site_Code", "Cusum_Statistic", "Level_of_Signal", "Reset_Flag",
             "Events_Desc", *FLAG_COLS, "Line_Type", "Line_Part"]


def signal_level(df: DataFrame) -> DataFrame:
    """Level 2 if S >= h2; else 0 in a month without events; else 1 if S >= h1; else 0."""
    s, x = F.col("Cusum_Statistic"), F.col("numerator")
    lvl = (F.when(s >= F.col("h_L2"), 2).when(x == 0, 0).when(s >= F.col("h_L1"), 1).otherwise(0))
    return (df.withColumn("Level_of_Signal", lvl)
            .withColumn("Reset_Flag", F.when(F.col("Level_of_Signal").isin(1, 2), F.lit("Signal"))
                        .otherwise(F.lit(""))))


def chart_dates(df: DataFrame) -> DataFrame:
    """Chart date = third-last day of the month; label 'Month yyyy'."""
    first = month_start(F.col("year_month"))
    return df.withColumns({"Cusum_Period": third_last_day(first), "Date_of_signal": month_label(first),
                           "Line_Part_Increment": F.lit(0), "Line_Type": F.lit("CUSUM")})


def event_tooltip(events: DataFrame, period_col: str, labels: dict, out: str) -> DataFrame:
    """L11/L16 tooltip: '2 Stillbirth(s), 1 Neonatal Death(s)' per (site, period).

    Counts per outcome first (partial aggregation), then a join of at most a
    few labels per group, ordered by label.
    """
    per = (events.groupBy("Site_Code", period_col, "outcome")
           .agg(F.sum("event_count").cast("long").alias("n")))
    lab = outcome_label(F.col("outcome"), labels)
    per = per.select("Site_Code", period_col, lab.alias("label"),
                     F.concat(F.col("n").cast("string"), F.lit(" "), lab).alias("item"))
    return per.groupBy("Site_Code", period_col).agg(sorted_join(F.col("label"), F.col("item")).alias(out))


def with_month_tooltip(cusum: DataFrame, events: DataFrame) -> DataFrame:
    """Monthly tooltip joined on (site, month); 'No events' where there are none."""
    tip = event_tooltip(events, "year_month", MONTH_LABELS, "Events_Desc")
    j = cusum.join(tip, ["Site_Code", "year_month"], "left")
    return j.withColumn("Events_Desc", F.coalesce(F.col("Events_Desc"), F.lit("No events")))


def recency_flags(df: DataFrame, latest=None) -> DataFrame:
    """Level 1/2 within the last 6 (<= 5 months back) and 12 (<= 11) months of the latest chart month.

    The latest month is a global scalar (scalar subquery), not an
    unpartitioned window. Callers that know a cheaper source of the same value
    (the newest month of the monthly counts) pass it as ``latest``.
    """
    if latest is None:
        latest = df.agg(F.max("Cusum_Period")).scalar()
    back = months_apart(F.col("Cusum_Period"), latest)
    lvl = F.col("Level_of_Signal")
    w6, w12 = back <= 5, back <= 11
    return df.withColumns({
        "Level1_6months": F.when(w6 & (lvl == 1), 1).otherwise(0),
        "Level2_6months": F.when(w6 & (lvl == 2), 1).otherwise(0),
        "Level1_12months": F.when(w12 & (lvl == 1), 1).otherwise(0),
        "Level2_12months": F.when(w12 & (lvl == 2), 1).otherwise(0),
    })


def cusum_output(df: DataFrame) -> DataFrame:
    """Monthly CUSUM rows in chart shape (CUSUM_Output_without_reset_rows)."""
    return df.select(F.col("Cusum_Period").alias("Date"), "Date_of_signal", "Site_Code", "Cusum_Statistic",
                     F.col("h_L1").alias("Level1_Threshold"), F.col("h_L2").alias("Level2_Threshold"),
                     "Level_of_Signal", "Reset_Flag", "Events_Desc", *FLAG_COLS, "Line_Part_Increment",
                     "Line_Type", "denominator", "Ref_Rate", "numerator")


def reset_rows(out: DataFrame) -> DataFrame:
    """For each level-2 month a row on the next day with S = 0, level 0, text 'Reset'."""
    return (out.filter(F.col("Level_of_Signal") == 2)
            .select(F.date_add("Date", 1).alias("Date"), "Date_of_signal", "Site_Code",
                    F.lit(0.0).alias("Cusum_Statistic"), F.lit(0).alias("Level_of_Signal"),
                    F.lit("Reset").alias("Reset_Flag"), F.lit("Reset").alias("Events_Desc"),
                    *[F.lit(0).alias(c) for c in FLAG_COLS], F.lit(1).alias("Line_Part_Increment"),
                    "Line_Type"))


def threshold_rows(out: DataFrame) -> DataFrame:
    """Both thresholds of each site-year at the year's start and end.

    Dates are clamped to [first chart date - 1 day, last day of the latest
    month]; a start before the window becomes 'Ref_End' with marker level 3
    (level 1) or 4 (level 2) and a label, all others are 'Ref' with level 0.
    """
    span = out.agg(F.struct(F.min("Date").alias("lo"), F.max("Date").alias("hi"))).scalar()
    lo = F.date_sub(span.getField("lo"), 1)
    hi = F.last_day(span.getField("hi"))
    y = F.year("Date")
    t = (out.select("Site_Code", F.make_date(y, F.lit(1), F.lit(1)).alias("Start_Date"),
                    F.make_date(y, F.lit(12), F.lit(31)).alias("End_Date"), "Level1_Threshold", "Level2_Threshold")
         .withColumns({"lo": lo, "hi": hi}).distinct())  # the span is read once, here
    # four rows each; a generator, unlike an unpivot, leaves the rows' partitioning by site as it is
    ends = [F.struct(F.lit(c).alias("Line_Type"), F.col(c).alias("Cusum_Statistic"), F.col(d).alias("Date"))
            for c in ("Level1_Threshold", "Level2_Threshold") for d in ("Start_Date", "End_Date")]
    t = t.select("Site_Code", "lo", "hi", F.inline(F.array(*ends)))
    lo, hi = F.col("lo"), F.col("hi")
    ref_end = F.col("Date") < lo
    is1, is2 = F.col("Line_Type") == "Level1_Threshold", F.col("Line_Type") == "Level2_Threshold"
    return t.select(
        F.when(F.col("Date") > hi, hi).when(ref_end, lo).otherwise(F.col("Date")).alias("Date"),
        F.when(ref_end, F.lit("Ref_End")).otherwise(F.lit("Ref")).alias("Date_of_signal"),
        "Site_Code", "Cusum_Statistic",
        F.when(ref_end & is1, 3).when(ref_end & is2, 4).otherwise(0).alias("Level_of_Signal"),
        F.when(ref_end & is1, F.lit("Level 1 Threshold")).when(ref_end & is2, F.lit("Level 2 Threshold"))
         .otherwise(F.lit("")).alias("Reset_Flag"),
        F.lit("NA").alias("Events_Desc"), *[F.lit(0).alias(c) for c in FLAG_COLS],
        "Line_Type", F.lit(0).alias("Line_Part"))


def line_set(out: DataFrame, resets: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Monthly rows + reset rows numbered into line segments (1 + running count of
    resets per site, by date), then the threshold rows (segment 0)."""
    base_cols = [c for c in resets.columns]
    months = out.select(*base_cols)
    both = months.unionByName(resets)
    w = Window.partitionBy("Site_Code").orderBy("Date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = both.withColumn("Line_Part", (1 + F.sum("Line_Part_Increment").over(w)).cast("int"))
    return numbered.select(*LINE_COLS).unionByName(thresholds.select(*LINE_COLS))
