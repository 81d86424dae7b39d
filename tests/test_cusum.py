"""CUSUM fold (E5) and closed form (E4) against a plain loop."""

import numpy as np
import pandas as pd
import pytest


def loop(xs, ks, h2s):
    s, out = 0.0, []
    for x, k, h2 in zip(xs, ks, h2s):
        prev = 0.0 if round(s, 6) >= h2 else s
        s = max(0.0, prev + x - k)
        out.append(round(s, 6))
    return out


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(7)
    rows = []
    for site in range(40):
        n = int(rng.integers(1, 30))
        k = float(rng.choice([0.61, 1.11, 0.63, 1.5]))
        for m in range(n):
            year = 2020 + m // 12
            rows.append((f"S{site:03d}", f"{year}-{m % 12 + 1:02d}", int(rng.poisson(1.2)), k,
                         2.0, 3.0 + (year % 2)))
    return pd.DataFrame(rows, columns=["Site_Code", "year_month", "numerator", "k", "h_L1", "h_L2"])


def test_fold_matches_loop(spark, series):
    from signalwatch.operators.cusum import cusum_reset
    got = cusum_reset(spark.createDataFrame(series)).toPandas()
    for site, g in series.groupby("Site_Code"):
        g = g.sort_values("year_month")
        exp = loop(g.numerator, g.k, g.h_L2)
        res = got[got.Site_Code == site].sort_values("year_month").Cusum_Statistic.tolist()
        assert res == pytest.approx(exp)


def test_no_reset_equals_fold_with_huge_h(spark, series):
    from signalwatch.operators.cusum import cusum_no_reset, cusum_reset
    big = series.assign(h_L2=1e12)
    a = cusum_reset(spark.createDataFrame(big)).toPandas().sort_values(["Site_Code", "year_month"])
    b = cusum_no_reset(spark.createDataFrame(big)).toPandas().sort_values(["Site_Code", "year_month"])
    assert a.Cusum_Statistic.tolist() == pytest.approx(b.Cusum_Statistic.tolist())
    assert (a.Cusum_Statistic >= 0).all()


def test_after_alarm_statistic_restarts(spark, series):
    from signalwatch.operators.cusum import cusum_reset
    got = cusum_reset(spark.createDataFrame(series)).toPandas().sort_values(["Site_Code", "year_month"])
    for _, g in got.groupby("Site_Code"):
        g = g.reset_index(drop=True)
        for i in range(1, len(g)):
            if round(g.Cusum_Statistic[i - 1], 6) >= g.h_L2[i]:
                assert g.Cusum_Statistic[i] <= g.numerator[i] + 1e-9


def test_missing_threshold_gives_null_and_restarts(spark):
    from signalwatch.operators.cusum import cusum_reset
    df = spark.createDataFrame([("A", "2025-01", 3, 0.5, 2.0, 4.0), ("A", "2025-02", 3, None, None, None),
                                ("A", "2025-03", 2, 0.5, 2.0, 4.0)],
                               "Site_Code string, year_month string, numerator int, k double, h_L1 double, h_L2 double")
    got = [r.Cusum_Statistic for r in cusum_reset(df).orderBy("year_month").collect()]
    assert got == [2.5, None, 1.5]
