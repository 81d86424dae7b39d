"""Daily events, the observed-minus-expected line (VLAD) and the final table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.functions.labels import outcome_label
from signalwatch.functions.text import sorted_join
from signalwatch.params import DAY_LABELS

VLAD_COLS = ["Date", "Site_Code", "Site_Name", "ODS_Code", "ODS_Name", "Excess_Events", "Signal_Flag", "Event_Type"]


def daily_events(events: DataFrame, by_site: bool = False) -> DataFrame:
    """Events per (site, day) with the daily tooltip.

    Dealt out by (site, day) once: the counts per outcome and the day's total and
    text are both worked out on that partitioning. ``by_site``: the events are a table
    bucketed by site with a few rows for each day, and stay where they are.
    """
    n = F.sum("event_count").cast("long").alias("n")
    per = (events if by_site else events.repartition("Site_Code", "test_date")).groupBy("Site_Code", "test_date", "outcome").agg(n)
    lab = outcome_label(F.col("outcome"), DAY_LABELS)
    per = per.select("Site_Code", "test_date", "n", lab.alias("label"),
                     F.concat(F.col("n").cast("string"), F.lit(" "), lab).alias("item"))
    return per.groupBy("Site_Code", "test_date").agg(
        F.sum("n").alias("daily_count"), sorted_join(F.col("label"), F.col("item")).alias("Event_Type"))


def daily_expand(monthly: DataFrame) -> DataFrame:
    """H4: one row per day of each charted month (first to last day)."""
    first = F.trunc("Date", "month")
    return monthly.select("Site_Code", "denominator", F.col("Ref_Rate").alias("event_rate"),
                          F.col("Level_of_Signal").alias("Signal_Flag"),
                          F.explode(F.sequence(first, F.last_day("Date"))).alias("Date_VLAD"))


def _months(monthly: DataFrame, daily: DataFrame, start: str | None = None, lines: DataFrame | None = None, line_cols: list[str] = ()) -> DataFrame:
    """One row per charted month with its events by day, its chart rows (with ``lines``) and the running excess:
    ``_before`` is that at its start, ``_end`` that at its end.

    Months, event days and chart rows are unioned and grouped by (site, month), and the excess runs over a site's
    months; so all that is dealt out, sorted or windowed has a few rows a month, never one a day. A site's months are
    bounded by the calendar whatever the event volume. Event days and chart rows outside the charted months drop out.
    """
    births_in_day = F.col("denominator") / F.dayofmonth(F.last_day("Date"))
    month = F.struct("Date", (births_in_day * F.col("Ref_Rate")).alias("expected"), F.col("Level_of_Signal").alias("flag"),
                     *([F.col(start).cast("double").alias("start")] if start else []))
    parts = {"m": (monthly, "Date", month),
             "e": (daily, "test_date", F.struct(F.col("test_date").alias("d"), F.col("daily_count").alias("n"), F.col("Event_Type").alias("text")))}
    if lines is not None:
        parts["l"] = (lines, "Date", F.struct(F.col("Date").alias("d"), *line_cols))
    types = {k: df.select(row.alias(k)).schema[k].dataType for k, (df, _, row) in parts.items()}
    rows = [df.select("Site_Code", F.trunc(day, "month").alias("_month"),
                      *((row if k == own else F.lit(None).cast(types[k])).alias(k) for k in types)) for own, (df, day, row) in parts.items()]
    g = reduce(DataFrame.unionByName, rows).groupBy("Site_Code", "_month").agg(
        F.first("m", ignorenulls=True).alias("m"), *(F.collect_list(k).alias(k) for k in types if k != "m")).filter("m is not null")
    by_month = Window.partitionBy("Site_Code").orderBy("_month")
    events = F.aggregate("e", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    own = events - F.col("m.expected") * F.dayofmonth(F.last_day("m.Date"))
    at_start = F.col("m.start") if start else F.lit(0.0)
    first = F.row_number().over(by_month) == 1
    g = g.select("*", F.when(first, at_start + own).otherwise(own).alias("_own"), first.alias("_first"))
    upto = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.count_if(F.col("_own").isNull()).over(upto) == 0
    before = F.when(F.col("_first"), at_start).otherwise(F.sum("_own").over(by_month.rowsBetween(Window.unboundedPreceding, -1)))
    return g.select("Site_Code", *(k for k in types if k != "m"), "m.Date", "m.expected", "m.flag",
                    F.when(known, before).alias("_before"), F.when(known, F.sum("_own").over(upto)).alias("_end"))


def _bit(d: Column) -> Column:
    """The bit of a day in its month's set of marked days."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(d))


def _days(months: DataFrame, lined: bool = False) -> DataFrame:
    """H4: the days of each row of ``_months``, with the running excess, the day's count, text and flag and, if ``lined``,
    its chart rows as an array. The flag is the month's level only on days with events.

    A month marks its days with events or chart rows, a few of its thirty, and works out there what they carry. A day then
    counts the marked days up to itself in a set of bits and looks up the last of them, so nothing is searched day by day.
    """
    others = [c for c in months.columns if c not in ("e", "l", "expected", "flag", "Date", "_before", "_end")]
    none = F.lit(0).cast("long")

    def mark(d: Column) -> Column:
        here = F.get(F.filter("e", lambda x: x["d"] == d), F.lit(0))
        return F.struct(F.aggregate("e", none, lambda a, x: a + F.when(x["d"] <= d, x["n"]).otherwise(none)).alias("seen"),
                        here["n"].alias("n"), here["text"].alias("text"), *([F.filter("l", lambda x: x["d"] == d).alias("chart")] if lined else []))
    day_of = lambda rows: F.transform(rows, lambda x: x["d"])
    marked = F.array_sort(F.array_union(day_of("e"), day_of("l")) if lined else day_of("e"))
    m = months.select(*others, "Date", "expected", "flag", "_before", "e", *(["l"] if lined else []), marked.alias("_marked"))
    m = m.select(*others, "Date", "expected", "flag", "_before", F.transform("_marked", mark).alias("_marks"),
                 F.aggregate("_marked", none, lambda a, d: a.bitwiseOR(_bit(d))).alias("_bits"))
    days = m.select(*others, "expected", "flag", "_before", "_marks", "_bits", F.inline(
        F.transform(F.sequence(F.trunc("Date", "month"), F.last_day("Date")), lambda d: F.struct(d.alias("d")))))
    bit = _bit(F.col("d"))
    last = F.get("_marks", F.bit_count(F.col("_bits").bitwiseAND(bit * 2 - 1)) - 1)
    here = F.when(F.col("_bits").bitwiseAND(bit) != 0, last)
    cnt = F.coalesce(here["n"], none)
    return days.select(*others, "d", (F.col("_before") + (F.coalesce(last["seen"], none) - F.col("expected") * F.dayofmonth("d"))).alias("cum"),
                       cnt.alias("cnt"), F.when(cnt > 0, F.col("flag")).otherwise(0).alias("flag"), here["text"].alias("text"),
                       *([here["chart"].alias("chart")] if lined else []))


def vlad(monthly: DataFrame, daily: DataFrame, start: str | None = None) -> DataFrame:
    """Expected events per day = (denominator / days in month) x rate; excess =
    observed - expected; cumulative excess per site in date order. The day's flag is
    the month's level only on days with events.

    The running excess is worked out month by month (``_months``); each month then makes its days where it lies.
    A day's excess is that before its month, and its month's events less expected ones up to the day.

    As in the reference a missing expected value makes the running total missing
    from that day on (a plain window SUM would skip it).

    ``start`` names a column of ``monthly`` with the running total before the site's
    first row (the same in all of its rows); it goes into the first month's excess, so
    the sum takes the same steps as one over all months.
    """
    return _days(_months(monthly, daily, start)).select(
        F.col("d").alias("Date_VLAD"), "Site_Code", F.col("cum").alias("cmltv_excess_events"), F.col("flag").alias("Signal_Flag"),
        F.col("cnt").alias("daily_count"), F.col("text").alias("Event_Type"))


def month_ends(monthly: DataFrame, daily: DataFrame, start: str | None = None) -> DataFrame:
    """The running excess at the last day of each charted month: the same value as the daily line's."""
    return _months(monthly, daily, start).select("Site_Code", F.last_day("Date").alias("Date_VLAD"), F.col("_end").alias("cmltv_excess_events"))


CHART_COLS = ["Date_of_signal", "Cusum_Statistic", "Level_of_Signal", "Reset_Flag", "Events_Desc", "Level1_6months",
             "Level2_6months", "Level1_12months", "Level2_12months", "Line_Type", "Line_Part"]


def final_table(monthly: DataFrame, daily: DataFrame, lines: DataFrame, provider: DataFrame, extra: list[str] = ()) -> DataFrame:
    """L17-L19 in one plan: daily line, site names and chart rows of the same day; the excess is
    blanked on level-2 threshold rows. A day may carry several chart rows.

    Months, event days and chart rows meet by (site, month), and the excess runs over months (``_months``). The site's
    names join there too. Each month then makes its days, and a day its chart rows, where the month lies: a day
    appears once per chart row, or once alone; chart rows on dates without a charted month drop out, as in the
    reference's left join from the daily line.

    ``extra`` names further columns of the chart rows to carry along (the notification
    columns; a day without a chart row is not notified).

    Same rows as the daily line left-joined to the chart rows and the sites; no row of a day is dealt out or sorted.
    """
    line_cols = [*CHART_COLS, *extra]
    p = provider.select(F.col("Site_Code").alias("ps_site"), "Site_Name",
                        F.col("Trust_Code").alias("ODS_Code"), F.col("Trust_Name").alias("ODS_Name"))
    months = _months(monthly, daily, None, lines, line_cols)
    days = _days(months.join(p, months.Site_Code == p.ps_site, "left").drop("ps_site"), lined=True)
    names = ["Site_Code", "Site_Name", "ODS_Code", "ODS_Name"]
    j = days.select("d", *names, "cum", "flag", "text", F.inline_outer("chart").alias("_d", *line_cols))
    lt = F.col("Line_Type")
    exc = F.when(lt.isNull() | (lt != "Level2_Threshold"), F.col("cum"))
    told = {c: F.coalesce(c, F.lit(0)).alias(c) for c in line_cols if c == "Email_Trust"}
    return j.select(F.col("d").alias("Date"), *names, exc.alias("Excess_Events"), F.col("flag").alias("Signal_Flag"),
                    F.col("text").alias("Event_Type"), *(told.get(c, F.col(c)) for c in line_cols))


def with_site_names(v: DataFrame, provider: DataFrame) -> DataFrame:
    """Site and trust names."""
    p = provider.select(F.col("Site_Code").alias("ps_site"), "Site_Name",
                        F.col("Trust_Code").alias("ODS_Code"), F.col("Trust_Name").alias("ODS_Name"))
    j = v.join(p, v.Site_Code == p.ps_site, "left")
    return j.select(F.col("Date_VLAD").alias("Date"), "Site_Code", "Site_Name", "ODS_Code", "ODS_Name",
                    F.col("cmltv_excess_events").alias("Excess_Events"), "Signal_Flag", "Event_Type")
