"""Runs whose outputs become visible together; joins in which blank keys match."""

import datetime as dt
import tempfile

import pytest

from dummy_data import frames

DAY = dt.date(2025, 7, 1)


def _flow(spark, day):
    from signalwatch.params import SignalParams
    from signalwatch.plans.signal_plan import SignalFlow
    return SignalFlow(*frames(spark), SignalParams(run_date=day))


def test_readers_see_whole_runs_only(spark, monkeypatch):
    from signalwatch.plans import pipeline
    from signalwatch.sources.commits import RunLog
    base = tempfile.mkdtemp(prefix="signalwatch-run-", dir="/tmp")
    log = RunLog(spark, base)
    assert log.read("final") is None and log.runs().count() == 0
    assert pipeline.run_committed(_flow(spark, DAY), base).Number_new_signals == 9
    assert log.read("final").count() == 549 and log.read("register", before=DAY) is None

    real = pipeline.write_parquet

    def stops(df, path):
        if path.endswith("/register"):
            raise RuntimeError("stopped")
        real(df, path)

    week = DAY + dt.timedelta(days=7)
    monkeypatch.setattr(pipeline, "write_parquet", stops)
    with pytest.raises(RuntimeError, match="stopped"):  # the final table and the signals are written by then
        pipeline.run_committed(_flow(spark, week), base)
    assert log.newest()["run_date"] == DAY and log.read("new_signals").count() == 9
    monkeypatch.setattr(pipeline, "write_parquet", real)
    assert pipeline.run_committed(_flow(spark, week), base).Number_new_signals == 0  # compared with the first run's register
    assert log.newest()["run_date"] == week and log.read("new_signals").count() == 0
    assert log.read("register", before=week).count() == 9 and log.runs().count() == 2


def test_unfinished_outputs_are_not_committed(spark):
    from signalwatch.sources.commits import RunLog
    log = RunLog(spark, tempfile.mkdtemp(prefix="signalwatch-run-", dir="/tmp"))
    run = log.start(DAY)
    spark.range(3).write.parquet(log.path(run, "a"))
    with pytest.raises(ValueError, match="not finished: b"):
        log.commit(run, DAY, ["a", "b"])
    assert log.read("a") is None
    log.commit(run, DAY, ["a"])
    assert log.read("a").count() == 3
    with pytest.raises(ValueError, match="no output b"):
        log.read("b")


def test_blank_keys_match_blank_keys(spark):
    from signalwatch.operators.grid import annual_denominators, match_keys, monthly_events, null_safe_grid
    left = spark.createDataFrame([("A", None, 1), (None, None, 2), (None, 3, 4), ("B", 3, 5)], "k string, j int, x int")
    right = spark.createDataFrame([("A", None, 10), (None, None, 20), ("B", 4, 30)], "k string, j int, y int")
    got = match_keys(left, right, ["k", "j"])
    assert got.columns == ["k", "j", "x", "y"]
    assert sorted((r.x, r.y) for r in got.collect() if r.y) == [(1, 10), (2, 20)] and got.count() == 4
    events = spark.createDataFrame([("A", "2025-01", 1), (None, "2025-01", 2), ("A", None, 3), (None, None, 4)],
                                   "Site_Code string, year_month string, event_count int")
    denoms = spark.createDataFrame([("A", 2024, 10, 9), (None, 2024, 6, 5), (None, None, 4, 3)],
                                   "Site_Code string, Year int, Term_Births int, Term_Live_Births int")
    rates = spark.createDataFrame([("2022-2024", 0.1)], "Year string, Ref_Rate double")
    monthly = monthly_events(events)
    rows = null_safe_grid(monthly, annual_denominators(denoms, monthly, null_safe=True), rates).collect()
    assert {(r.Site_Code, r.year_month): (r.numerator, r.denominator, r.Ref_Rate) for r in rows} == {
        ("A", "2025-01"): (1, 10.0, 0.1), ("A", None): (3, None, None), (None, "2025-01"): (2, 6.0, 0.1), (None, None): (4, 4.0, None)}
