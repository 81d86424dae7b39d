"""Golden run on the reference's dummy data against the hand-computed values (FIXTURES.md section 3)."""

import datetime as dt

import pytest

from dummy_data import frames


@pytest.fixture(scope="module")
def flow(spark):
    from signalwatch.params import SignalParams
    from signalwatch.plans.signal_plan import SignalFlow
    events, denoms, rates, provider = frames(spark)
    return SignalFlow(events, denoms, rates, provider, SignalParams(run_date=dt.date(2025, 7, 1)))


def test_parameters_and_thresholds(flow):
    ctl = {r.Site_Code: r for r in flow.control.collect()}
    assert round(ctl["ABC01"].denominator, 6) == 208.333333
    assert round(ctl["ABC02"].denominator, 6) == 385.25
    assert round(ctl["ABC03"].denominator, 6) == 220.166667
    assert [ctl[s].inControlCount for s in ("ABC01", "ABC02", "ABC03")] == [0.42, 0.77, 0.44]
    th = {r.ic: r for r in flow.threshold_table.collect()}
    assert (round(th[0.42].k, 2), th[0.42].h_L1, th[0.42].h_L2) == (0.61, 1.40, 3.18)
    assert (round(th[0.77].k, 2), th[0.77].h_L1, th[0.77].h_L2) == (1.11, 1.79, 3.68)
    assert (round(th[0.44].k, 2), th[0.44].h_L1, th[0.44].h_L2) == (0.63, 1.49, 3.23)


EXPECTED = {  # (statistic, level, cumulative excess at month end)
    "ABC01": [(1.39, 0, 1.583333), (1.78, 1, 2.166667), (2.17, 1, 2.75), (4.56, 2, 5.333333), (2.39, 1, 7.916667),
              (1.78, 0, 7.5)],
    "ABC02": [(0, 0, 0.2295), (0, 0, 0.459), (1.89, 1, 2.6885), (1.78, 0, 2.918), (1.67, 0, 3.1475),
              (3.56, 1, 5.377)],
    "ABC03": [(1.37, 0, 1.559667), (2.74, 1, 3.119333), (3.11, 1, 3.679), (5.48, 2, 6.238667), (0, 0, 5.798333),
              (1.37, 0, 7.358)],
}


def test_cusum_levels_and_vlad(flow):
    from pyspark.sql import functions as F
    rows = flow.cusum_out.orderBy("Site_Code", "Date").collect()
    got = {}
    for r in rows:
        got.setdefault(r.Site_Code, []).append((round(r.Cusum_Statistic, 6), r.Level_of_Signal))
    for site, exp in EXPECTED.items():
        assert got[site] == [(e[0], e[1]) for e in exp]
    month_end = (flow.vlad.filter(F.col("Date_VLAD") == F.last_day("Date_VLAD"))
                 .orderBy("Site_Code", "Date_VLAD").collect())
    ex = {}
    for r in month_end:
        ex.setdefault(r.Site_Code, []).append(round(r.cmltv_excess_events, 6))
    for site, exp in EXPECTED.items():
        assert ex[site] == [e[2] for e in exp]


def test_counts(flow):
    from pyspark.sql import functions as F
    assert flow.grid.count() == 18
    resets = flow.resets.collect()
    assert len(resets) == 2 and {r.Date for r in resets} == {dt.date(2025, 4, 29)}
    thr = flow.threshold_lines.collect()
    assert len(thr) == 12
    assert {(r.Date, r.Date_of_signal) for r in thr} == {(dt.date(2025, 1, 28), "Ref_End"),
                                                        (dt.date(2025, 6, 30), "Ref")}
    assert {r.Level_of_Signal for r in thr if r.Date_of_signal == "Ref_End"} == {3, 4}
    assert flow.vlad.count() == 543
    assert flow.final.count() == 549
    reg = flow.register.groupBy("Site_Code").count().collect()
    assert {r.Site_Code: r["count"] for r in reg} == {"ABC01": 4, "ABC02": 2, "ABC03": 3}
    assert flow.final.filter(F.col("Excess_Events").isNull()).count() == 6


def test_tooltips(flow):
    from pyspark.sql import functions as F
    tips = {(r.Site_Code, r.year_month): r.Events_Desc for r in flow.with_tooltip.collect()}
    assert tips[("ABC01", "2025-04")] == "1 Neonatal Death(s), 2 Stillbirth(s)"
    assert tips[("ABC02", "2025-03")] == "1 Neonatal Death(s), 2 Stillbirth(s)"
    assert tips[("ABC01", "2025-06")] == "No events"
    assert tips[("ABC03", "2025-05")] == "No events"
    day = flow.daily.filter((F.col("Site_Code") == "ABC01") & (F.col("test_date") == dt.date(2025, 5, 16))).first()
    assert day.Event_Type == "1 Term Neonatal Death(s)"
    assert flow.daily.count() == 30


def test_register_first_run(flow):
    from pyspark.sql import functions as F
    cmp = flow.compare.collect()
    assert len(cmp) == 9 and all(r.Email_Trust == 1 and r.Date_Email == dt.date(2025, 7, 1) for r in cmp)
    due = flow.notified.filter(F.col("Email_Trust") == 1).select("Date_Checklist").distinct().collect()
    assert [r.Date_Checklist for r in due] == [dt.date(2025, 7, 11)]
    s = flow.summary.first()
    assert s.Number_new_signals == 9 and s.Number_lower_signals == 0
    assert s.Message.startswith("Signal run finished; events up to 2025-06-27; new signals: 9 (")


def test_register_second_run_is_quiet(spark, flow):
    """Running again against this run's own register finds no new signal (idempotent re-run)."""
    from signalwatch.params import SignalParams
    from signalwatch.plans.signal_plan import SignalFlow
    events, denoms, rates, provider = frames(spark)
    old = flow.new_register
    again = SignalFlow(events, denoms, rates, provider, SignalParams(run_date=dt.date(2025, 7, 8)), old_register=old)
    assert again.compare.filter("Email_Trust = 1").count() == 0
    assert again.summary.first().Number_new_signals == 0
    assert again.dropped.count() == 0


def test_final_in_one_pass_equals_join_form(flow):
    """The one-shuffle final table has the rows of the daily line left-joined to the chart rows."""
    from pyspark.sql import functions as F
    j = flow.vlad_named.join(flow.lines, ["Site_Code", "Date"], "left")
    blank = F.coalesce(F.col("Line_Type") == "Level2_Threshold", F.lit(False))
    j = j.withColumn("Excess_Events", F.when(~blank, F.col("Excess_Events"))).select(*flow.final.columns)
    a = sorted(map(tuple, flow.final.collect()), key=str)
    assert a == sorted(map(tuple, j.collect()), key=str) and len(a) == 549
