"""Incremental refresh: runs that continue equal a full run; long series."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def _flow(spark, events_filter=None):
    from signalwatch.plans.signal_plan import SignalFlow
    from signalwatch.plans.testbed_plan import shared_flows
    full = shared_flows(spark, SF)["fixed"]
    events = full.events_in if events_filter is None else full.events_in.filter(events_filter)
    return SignalFlow(events, full.denoms_in, full.rates, full.provider, full.p, persist=True)


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


CHART = ["Site_Code", "year_month", "numerator", "Cusum_Statistic", "Level_of_Signal"]
LINE = ["Site_Code", "Date_VLAD", "cmltv_excess_events", "Signal_Flag", "daily_count", "Event_Type"]


def test_three_runs_equal_a_full_run(spark):
    from signalwatch.operators import carry
    base = tempfile.mkdtemp(prefix="signalwatch-carry-", dir="/tmp")
    full = _flow(spark)
    months = sorted(r[0] for r in full.monthly.select("year_month").distinct().collect())
    site = F.substring("Site_Code", 4, 20).cast("long")
    late = (site % 5 == 2) & (F.dayofmonth("test_date") % 4 == 3)
    weeks = [(F.col("year_month") < months[-3]) & ~late, F.col("year_month") < months[-1], F.lit(True)]
    kept = []
    for k, only in enumerate(weeks):
        flow = _flow(spark, only)
        carry.refresh(flow.with_thresholds, flow.daily, base, dt.date(2002, 1, 1) + dt.timedelta(days=7 * k))
        state = carry.current_state(spark, base)
        kept.append((state.count(), state.filter("since < run_date").count()))
        assert _rows(carry.current(spark, base, "chart"), *CHART) == _rows(flow.levels, *CHART)
        assert _rows(carry.current(spark, base, "line"), *LINE) == _rows(flow.vlad, *LINE)
    assert kept[0][1] == 0 and 0 < kept[1][1] < kept[1][0] and kept[2][1] == kept[2][0]
    rows = spark.read.parquet(f"{base}/chart").filter(F.col("run_date") == "2002-01-15")
    assert rows.select("year_month").distinct().count() == 2  # the last run made the newly closed and the open month only


def test_unfinished_run_is_not_seen(spark):
    from signalwatch.operators import carry
    base = tempfile.mkdtemp(prefix="signalwatch-carry-", dir="/tmp")
    flow = _flow(spark)
    carry.refresh(flow.with_thresholds, flow.daily, base, dt.date(2002, 1, 1))
    before = _rows(carry.current(spark, base, "line"), *LINE)
    broken = flow.daily.withColumn("daily_count", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        carry.refresh(flow.with_thresholds, broken, base, dt.date(2002, 1, 8))
    assert _rows(carry.current(spark, base, "line"), *LINE) == before
    carry.refresh(flow.with_thresholds, flow.daily, base, dt.date(2002, 1, 8))
    assert _rows(carry.current(spark, base, "line"), *LINE) == before


def test_missing_values_and_vanished_sites(spark):
    from signalwatch.operators import carry
    base = tempfile.mkdtemp(prefix="signalwatch-carry-", dir="/tmp")
    schema = ("Site_Code string, year_month string, numerator long, refrate_period string, Ref_Rate double, Event_Year int, "
              "denominator double, k double, h_L1 double, h_L2 double")
    rows = [(s, f"2025-{m:02d}", m % 3, "p", None if (s, m) == ("B", 2) else 0.01, 2025, 9.0, *((None,) * 3 if (s, m) == ("B", 2) else (0.5, 1.0, 2.0)))
            for s in "ABC" for m in range(1, 7)]
    daily = spark.createDataFrame([(s, dt.date(2025, m, 5), m % 3, None) for s in "ABC" for m in (1, 2, 4, 5)],
                                  "Site_Code string, test_date date, daily_count long, Event_Type string")
    from signalwatch.operators import cusum, vlad
    for day, months, sites in ((1, 4, "ABC"), (8, 6, "AB")):
        part = spark.createDataFrame([r for r in rows if r[1] <= f"2025-{months:02d}" and r[0] in sites], schema)
        events = daily.filter(F.col("Site_Code").isin(*sites)).filter(F.month("test_date") <= months)
        carry.refresh(part, events, base, dt.date(2025, 7, day))
    cols = CHART[:4]
    assert _rows(carry.current(spark, base, "chart"), *cols) == _rows(cusum.cusum_reset(part), *cols)
    line = carry.current(spark, base, "line")
    from signalwatch.operators import lines
    full = lines.chart_dates(lines.signal_level(cusum.cusum_reset(part))).withColumnRenamed("Cusum_Period", "Date")
    assert _rows(line, *LINE) == _rows(vlad.vlad(full, events), *LINE)
    assert carry.current_state(spark, base).filter("since < run_date").count() == 2


def test_long_series_equals_a_loop(spark):
    """Daily order keys: some ten thousand rows of one site, and lengths around the block's."""
    import numpy as np
    from signalwatch.operators.cusum import BLOCK, cusum_reset
    from test_cusum import loop
    rng = np.random.default_rng(3)
    sizes = {"long": 12_000, "one": 1, "block": BLOCK, "more": BLOCK + 1, "two": 2 * BLOCK}
    series = {s: rng.poisson(1.2, n).tolist() for s, n in sizes.items()}
    rows = [(s, f"{t:06d}", x, 1.11, 3.0) for s, xs in series.items() for t, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "Site_Code string, day string, numerator int, k double, h_L2 double")
    got = {}
    for r in cusum_reset(df, order="day").collect():
        got.setdefault(r.Site_Code, {})[r.day] = r.Cusum_Statistic
    for s, xs in series.items():
        assert [got[s][t] for t in sorted(got[s])] == pytest.approx(loop(xs, [1.11] * len(xs), [3.0] * len(xs)))
