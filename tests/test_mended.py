"""Cases that once went wrong: readers by header, nameless sites, broken registers, far due dates, lost keys, rounding."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from dummy_data import frames


def _tmp():
    return tempfile.mkdtemp(prefix="signalwatch-mended-", dir="/tmp")


def _write(lines):
    path = os.path.join(_tmp(), "f.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def _flow(spark, run_date=dt.date(2025, 7, 1), provider=None, events=None, **kw):
    from signalwatch.params import SignalParams
    from signalwatch.plans.signal_plan import SignalFlow
    ev, denoms, rates, prov = frames(spark)
    return SignalFlow(events or ev, denoms, kw.pop("rates", rates), provider or prov, SignalParams(run_date=run_date), **kw)


def test_columns_are_found_by_name(spark):
    from signalwatch.sources.readers import read_events, read_ref_rate
    rates = read_ref_rate(spark, _write(["Site_Code,Year,Ref_Rate,Denom,Events,Source", "ABC01,2022-2024,0.002,100000,200,x"])).first()
    assert (rates.Site_Code, rates.Year, rates.Events, rates.Denom, rates.Ref_Rate) == ("ABC01", "2022-2024", 200, 100000, 0.002)
    ev = read_events(spark, _write([
        "Baby_ID,outcome,event_count,year_month,test_date,Trust_Name,Site_Name,Site_Code,ods_code",
        "b1,SB,1,2025-01,05/01/2025,T,S,ABC01,ABC"])).first()
    assert (ev.Site_Code, ev.test_date, ev.event_count, ev.outcome) == ("ABC01", dt.date(2025, 1, 5), 1, "SB")


def test_a_missing_column_is_an_error(spark):
    from signalwatch.sources.readers import read_ref_rate
    with pytest.raises(ValueError, match="Ref_Rate"):
        read_ref_rate(spark, _write(["Year,Events,Denom,Source", "2022-2024,200,100000,x"]))


def test_unparsable_values_are_counted(spark):
    from signalwatch.sources import schemas
    from signalwatch.sources.readers import read_ref_rate, unparsable
    path = _write(["Year,Events,Denom,Ref_Rate,Source", "2022-2024,many,100000,0.002,x", "2021-2023,5,,zero,y"])
    bad = unparsable(spark, path, schemas.REF_RATE_CSV).first().asDict()
    assert bad == {"Year": 0, "Events": 1, "Denom": 0, "Ref_Rate": 1, "Source": 0}
    assert [r.Events for r in read_ref_rate(spark, path).collect()] == [None, 5]


def test_rates_by_site(spark):
    """A rate file with a site column gives each site its own rate."""
    _, _, rates, _ = frames(spark)
    one = rates.withColumn("Site_Code", F.lit("ABC01")).unionByName(
        rates.withColumns({"Site_Code": F.lit("ABC02"), "Ref_Rate": F.lit(0.004)}))
    got = {r.Site_Code: r.Ref_Rate for r in _flow(spark, rates=one).df_for_cusum.select("Site_Code", "Ref_Rate").distinct().collect()}
    assert got == {"ABC01": 0.002, "ABC02": 0.004, "ABC03": None}


def test_source_inputs_are_read(spark):
    from signalwatch.sources import readers
    births = readers.read_births(spark, _write([
        "Dob,Actual_delivery_Ods_Code,Der_Pseudo_Nhs_Number,Gestation_Age,Postcode_Of_Birth,Dod,Num_Days_From_Dob_To_Dod,"
        "Deceased_Type_Flag", "20250103,ABC01,b1,Gestation_over37,P1,2025-01-05,2,Neonatal"])).first()
    assert births.Dob == "20250103" and births.Dod == dt.date(2025, 1, 5) and births.Num_Days_From_Dob_To_Dod == 2
    assert readers.read_site_mergers(spark, _write(["New_Code,Old_Code", "N,O"])).first().Old_Code == "O"
    assert readers.read_postcode_mapping(spark, _write([
        "PostCode,Site_Code_Old,Site_Code_New,Map_using_postcode,Justification", "P,A,B,1,x"])).first().Map_using_postcode == 1


def test_a_site_without_a_name_is_notified(spark):
    _, _, _, provider = frames(spark)
    flow = _flow(spark, provider=provider.filter("Site_Code <> 'ABC03'"))
    assert flow.compare.filter("Email_Trust = 1").count() == 9
    assert flow.notified.filter("Email_Trust = 1").count() == 9
    s = flow.summary.first()
    assert s.Number_new_signals == 9 and "ABC03" in s.New_Site_Names and s.Message.count("ABC03") == 3


def test_summary_without_events(spark):
    events = frames(spark)[0]
    s = _flow(spark, events=events.filter("false")).summary.first()
    assert s.Latest_Date is None and s.Message == "Signal run finished; events up to none; new signals: 0."


def test_only_a_missing_register_is_a_first_run(spark):
    from signalwatch.sources.readers import read_register
    base = _tmp()
    assert read_register(spark, os.path.join(base, "none"), dt.date(2025, 7, 1)) is None
    os.makedirs(os.path.join(base, "broken", "run_date=2025-06-01"))
    with open(os.path.join(base, "broken", "run_date=2025-06-01", "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        read_register(spark, os.path.join(base, "broken"), dt.date(2025, 7, 1)).collect()


@pytest.mark.parametrize("day,due", [(dt.date(2027, 12, 24), dt.date(2028, 1, 10)), (dt.date(2026, 12, 24), dt.date(2027, 1, 8))])
def test_due_dates_beyond_the_data(spark, day, due):
    got = _flow(spark, run_date=day).notified.filter("Email_Trust = 1").select("Date_Checklist").distinct().collect()
    assert [r[0] for r in got] == [due]


def test_a_long_closure_moves_the_due_date(spark):
    from signalwatch.operators.workdays import add_working_days
    closed = spark.createDataFrame([(dt.date(2025, 1, 1) + dt.timedelta(days=k),) for k in range(200)], "holiday date")
    got = add_working_days(spark.createDataFrame([(dt.date(2025, 1, 1),)], "d date"), "d", 8, closed, "due").first()
    assert got.due == dt.date(2025, 7, 30)


def test_events_without_a_key_are_counted(spark):
    events = frames(spark)[0]
    lost = events.limit(2).withColumn("year_month", F.lit(None).cast("string"))
    flow = _flow(spark, events=events.unionByName(lost))
    assert flow.signal_gates.first().events_without_key == 2 and flow.grid.count() == 18


def test_rounding_takes_the_nearer_neighbour(spark):
    from signalwatch.functions.rounding import round_half_even
    for x, want in ((0.002 * 102.5, 0.21), (0.125, 0.12), (0.375, 0.38), (0.15, 0.15), (2.675, 2.67), (1.005, 1.0), (0.285, 0.28),
                    (1.115, 1.11), (5.015, 5.01), (-0.125, -0.12), (0.0, 0.0), (0.295, 0.29)):
        got = spark.range(1).select(round_half_even(F.lit(x), 2)).first()[0]
        lo, hi = sorted({float(f"{int(x * 100 - (x < 0)) / 100}"), (int(x * 100 - (x < 0)) + 1) / 100})
        assert got == pytest.approx(want) or abs(got - x) <= min(abs(lo - x), abs(hi - x)), (x, got)
    assert spark.range(1).select(round_half_even(F.lit(0.002 * 102.5), 2)).first()[0] == 0.21


def test_a_month_of_babies_without_ids_keeps_its_row(spark):
    from signalwatch.operators.denominators import births_by_month, live_births
    rows = [("S", "T", dt.date(2025, 1, 31), None, "Stillbirth"), ("S", "T", dt.date(2025, 2, 28), "b", None),
            ("S", "T", dt.date(2025, 2, 28), "b", None), ("S", "T", dt.date(2025, 2, 28), None, None)]
    got = live_births(births_by_month(spark.createDataFrame(
        rows, "Site_Code string, ods_code string, Period date, Baby_ID string, Deceased_Type_Flag string"))).orderBy("Period").collect()
    assert [(r.Term_Births, r.Term_Live_Births) for r in got] == [(0, 0), (1, 1)]


def test_two_weekly_runs_on_disk(spark):
    """The second run compares with the register of the first one."""
    from signalwatch.plans.pipeline import run_signals
    out = _tmp()
    flow = _flow(spark)
    assert run_signals(flow, out).Number_new_signals == 9
    assert not os.path.exists(flow.folder.path.removeprefix("file:"))
    assert run_signals(_flow(spark, run_date=dt.date(2025, 7, 8)), out).Number_new_signals == 0
    assert spark.read.parquet(os.path.join(out, "new_signals")).groupBy("run_date").count().collect()[0]["count"] == 9
    assert run_signals(_flow(spark), out).Number_new_signals == 9  # the first day again: nothing earlier to compare with


def test_no_size_changes_the_design():
    from signalwatch.operators.thresholds import design_for_ic
    large = design_for_ic(60.0)
    assert round(large["k"], 2) == round(60 / 0.6931471805599453, 2) and large["arl_L2"] >= 100
