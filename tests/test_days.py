"""The days of the final table: a month marks its few days with events or chart rows, the others only look them up."""

import datetime as dt
import re

from pyspark.sql import functions as F

from signalwatch.operators import vlad

MONTHS = [("A", "2000-01-29", 31.0, 0.1, 2), ("A", "2000-02-27", 29.0, 0.2, 1), ("A", "2000-03-29", 31.0, 0.1, 0), ("B", "2000-01-29", 62.0, 0.1, 0)]
EVENTS = [("A", "2000-01-01", 2, "two"), ("A", "2000-01-31", 1, "one"), ("A", "2000-02-27", 3, "three"), ("A", "2000-02-29", 1, "one"),
          ("B", "2000-01-15", 1, "one"), ("B", "2000-01-16", 4, "four"), ("C", "2000-01-02", 1, "one")]
LINES = [("A", "2000-01-29", "CUSUM"), ("A", "2000-01-01", "Level1_Threshold"), ("A", "2000-01-01", "Level2_Threshold"),
         ("A", "2000-02-27", "CUSUM"), ("A", "2000-03-31", "Level2_Threshold"), ("B", "2000-01-31", "CUSUM"), ("B", "2001-01-01", "CUSUM")]


def _inputs(spark):
    day = F.to_date("Date")
    months = spark.createDataFrame(MONTHS, "Site_Code string, Date string, denominator double, Ref_Rate double, Level_of_Signal int").withColumn("Date", day)
    daily = spark.createDataFrame(EVENTS, "Site_Code string, Date string, daily_count long, Event_Type string").select(
        "Site_Code", day.alias("test_date"), "daily_count", "Event_Type")
    lines = spark.createDataFrame(LINES, "Site_Code string, Date string, Line_Type string").withColumn("Date", day)
    lines = lines.withColumns({c: F.lit(1) for c in vlad.CHART_COLS if c != "Line_Type"})
    sites = spark.createDataFrame([("A", "a", "T", "t")], "Site_Code string, Site_Name string, Trust_Code string, Trust_Name string")
    return months, daily, lines, sites


def _plain():
    rows, total = [], {}
    for site, date, births, rate, level in MONTHS:
        d = dt.date.fromisoformat(date).replace(day=1)
        n = ((d + dt.timedelta(days=31)).replace(day=1) - d).days
        for k in range(n):
            x = d + dt.timedelta(days=k)
            here = [(c, t) for s, e, c, t in EVENTS if s == site and e == str(x)]
            total[site] = total.get(site, 0.0) + sum(c for c, _ in here) - births / n * rate
            for lt in [t for s, e, t in LINES if s == site and e == str(x)] or [None]:
                rows.append((site, str(x), None if lt == "Level2_Threshold" else round(total[site], 6), level if here else 0,
                             here[0][1] if here else None, lt))
    return sorted(rows, key=str)


def test_marked_days_against_a_loop(spark):
    """Events and chart rows on first, last and shared days, several chart rows of a day, months without either."""
    final = vlad.final_table(*_inputs(spark))
    got = [(r.Site_Code, str(r.Date), None if r.Excess_Events is None else round(r.Excess_Events, 6), r.Signal_Flag, r.Event_Type, r.Line_Type)
           for r in final.collect()]
    assert sorted(got, key=str) == _plain()
    assert {(r.Site_Code, r.Site_Name) for r in final.select("Site_Code", "Site_Name").collect()} == {("A", "a"), ("B", None)}


def test_days_search_nothing(spark):
    """The generator of the days makes dates alone; events and chart rows are searched for the marked days of a month."""
    months, daily, lines, sites = _inputs(spark)
    for df in (vlad.vlad(months, daily), vlad.final_table(months, daily, lines, sites)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        made = re.findall(r"Generate inline\(transform\(sequence\(trunc\(Date.*", plan)
        assert made and not any("filter(" in g or "aggregate(" in g for g in made)
