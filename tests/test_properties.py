"""Properties and semantic notes on the test tables (sf0.001) and small hand-made series."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flow(spark):
    from signalwatch.plans.testbed_plan import shared_flows
    return shared_flows(spark, SF)["fixed"]


def test_grid_is_sites_times_months(flow):
    sites = flow.grid.select("Site_Code").distinct().count()
    months = flow.monthly.select("year_month").distinct().count()
    assert flow.grid.count() == sites * months
    assert flow.grid.select("Site_Code", "year_month").distinct().count() == sites * months


def test_vlad_end_value(flow):
    """Cumulative excess at a site's last day = its events - sum over months of rate x denominator."""
    last = (flow.vlad.groupBy("Site_Code").agg(F.max_by("cmltv_excess_events", "Date_VLAD").alias("end"),
                                               F.sum("daily_count").alias("events")))
    exp = (flow.cusum_out.groupBy("Site_Code").agg(F.sum(F.col("Ref_Rate") * F.col("denominator")).alias("expected"),
                                                   F.count_if(F.col("denominator").isNull()).alias("gaps")))
    short = exp.filter("gaps > 0")  # the supplier without its last year: no running excess from there on
    assert short.count() == 1 and last.join(short, "Site_Code").first().end is None
    for r in last.join(exp.filter("gaps = 0"), "Site_Code").collect():
        assert r.end == pytest.approx(r.events - r.expected, abs=1e-6)


def test_statistic_non_negative_and_levels(flow):
    c = flow.cusum_out
    assert c.filter(F.col("Cusum_Statistic") < 0).count() == 0
    assert c.filter((F.col("Level_of_Signal") == 1) & (F.col("numerator") == 0)).count() == 0
    assert c.filter((F.col("Level_of_Signal") == 2) & (F.col("Cusum_Statistic") < F.col("Level2_Threshold"))).count() == 0


def test_days_without_chart_row_are_not_notified(flow):
    n = flow.notified
    assert n.filter(F.col("Reset_Flag").isNull() & ((F.col("Email_Trust") != 0) | F.col("Date_Email").isNotNull())
                    ).count() == 0
    assert n.filter((F.col("Reset_Flag") == "Reset") & (F.col("Email_Trust") == 1)).count() == 0


def test_reset_uses_next_rows_h2_across_year_end(spark):
    """The carried statistic is tested against the NEW row's level-2 threshold."""
    from signalwatch.operators.cusum import cusum_reset
    from signalwatch.operators.lines import signal_level
    rows = [("A", "2024-12", 5, 0.5, 2.0, 5.0), ("A", "2025-01", 1, 0.5, 2.0, 4.0)]
    df = spark.createDataFrame(rows, "Site_Code string, year_month string, numerator int, k double, "
                                     "h_L1 double, h_L2 double")
    got = signal_level(cusum_reset(df)).orderBy("year_month").collect()
    assert got[0].Cusum_Statistic == 4.5 and got[0].Level_of_Signal == 1    # 4.5 < own h2 = 5
    assert got[1].Cusum_Statistic == 0.5                                   # 4.5 >= next h2 = 4: reset


def test_upgrade_notifies_again(spark):
    """A level-1 signal that becomes level 2 has a new ID and notifies again."""
    from signalwatch.operators.register import register_compare
    new = spark.createDataFrame([("S1-May 2025-2", "S1", "n", "T", "t")],
                                "ID string, Site_Code string, Site_Name string, ODS_Code string, ODS_Name string")
    old = spark.createDataFrame([("S1-May 2025-1", "S1", "n", "T", "t", dt.date(2025, 6, 1))],
                                "ID string, Site_Code string, Site_Name string, ODS_Code string, ODS_Name string, "
                                "Date_Email date")
    r = register_compare(new, old, dt.date(2025, 7, 1)).first()
    assert r.Email_Trust == 1 and r.Date_Email == dt.date(2025, 7, 1)


def test_contract(spark):
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}  # the rest belongs to a subpackage that may be absent
    assert set(o) <= set(q) and own == set(o) & own
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["Date", "Site_Code", "Site_Name"]


def test_full_month_calendar_option(spark):
    """With the option, a month without any event still gets grid rows."""
    from signalwatch.operators.grid import month_grid
    monthly = spark.createDataFrame([("A", "2025-01", 1), ("A", "2025-03", 2)],
                                    "Site_Code string, year_month string, monthly_count long")
    annual = spark.createDataFrame([("A", 2024, 9.0, 8.0), ("B", 2024, 7.0, 6.0)],
                                   "Site_Code string, Year int, Monthly_Term_Births double, Monthly_Term_Live_Births double")
    rates = spark.createDataFrame([("2022-2024", 0.002)], "Year string, Ref_Rate double")
    default = month_grid(monthly, annual, rates)
    full = month_grid(monthly, annual, rates, full_calendar=True)
    assert {(r.Site_Code, r.denominator) for r in full.collect()} == {("A", 9.0), ("B", 7.0)}
    assert sorted({r.year_month for r in default.collect()}) == ["2025-01", "2025-03"]
    rows = {(r.Site_Code, r.year_month): r.numerator for r in full.collect()}
    assert len(rows) == 6 and rows[("A", "2025-02")] == 0 and rows[("A", "2025-03")] == 2


def test_mapping_gates(spark):
    from signalwatch.operators.quality import mapping_gates
    prov = spark.createDataFrame([("S1", "a", "T", "t"), ("S1", "b", "T", "t"), ("S2", "c", "T", "t")],
                                 "Site_Code string, Site_Name string, Trust_Code string, Trust_Name string")
    merg = spark.createDataFrame([("O1", "N1"), ("O1", "N2")], "Old_Code string, New_Code string")
    pmap = spark.createDataFrame([("S1", "P", "S2", 1, "x")], "Site_Code_Old string, PostCode string, "
                                 "Site_Code_New string, Map_using_postcode int, Justification string")
    g = mapping_gates(prov, merg, pmap).first()
    assert (g.duplicate_provider_sites, g.duplicate_merger_codes, g.duplicate_postcode_keys) == (1, 1, 0)


def test_ties_to_even_rounding(spark):
    """Parameters round ties to even (R's rule), unlike Spark's round()."""
    from signalwatch.functions.rounding import round_half_even, round_to_step
    r = spark.range(1).select(round_half_even(F.lit(0.125), 2).alias("a"), round_half_even(F.lit(2.5), 0).alias("b"),
                              round_to_step(F.lit(0.605), 0.01).alias("c"), F.round(F.lit(2.5), 0).alias("d")).first()
    assert (r.a, r.b, r.d) == (0.12, 2.0, 3.0)
    assert round(r.c, 2) == 0.6


def test_unknown_outcome_label(spark):
    """A NULL or unexpected code is labelled 'Unknown'; HIE keeps its label."""
    from signalwatch.operators.lines import event_tooltip
    from signalwatch.params import MONTH_LABELS
    ev = spark.createDataFrame([("A", "2025-01", 1, None), ("A", "2025-01", 1, "HIE"), ("A", "2025-01", 1, "XX")],
                               "Site_Code string, year_month string, event_count int, outcome string")
    assert event_tooltip(ev, "year_month", MONTH_LABELS, "t").first().t == "1 HIE(s), 1 Unknown, 1 Unknown"


def test_id_parts_with_dash_in_site_code(spark):
    """The ID is cut with the known site code, so '-' inside a code is harmless."""
    from signalwatch.operators.register import register_dropped
    old = spark.createDataFrame([("AB-1-May 2025-2", "AB-1", "n", "T", "t", dt.date(2025, 6, 1))],
                                "ID string, Site_Code string, Site_Name string, ODS_Code string, ODS_Name string, "
                                "Date_Email date")
    new = old.limit(0).drop("Date_Email")
    r = register_dropped(old, new).first()
    assert (r.Site_Code, r.Date_of_signal, r.Level_of_Signal_Old) == ("AB-1", "May 2025", "2")


def test_births_are_cleaned_whole_and_from_a_date(spark):
    """One registered query over all births, one with the start date."""
    import __spark_entry__ as E
    sf, q = "/root/testdata/sf0.001", E.queries()
    everything, later = q["clean_births_all"](spark, sf), q["clean_births"](spark, sf)
    early = everything.filter("date_of_birth < '1996-01-01'").count()
    assert early > 0 and everything.count() == early + later.count() and "clean_births_all" in E.oracle_sql()
