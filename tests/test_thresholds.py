"""ARL design (L6): fixed points and monotonicity."""

import pytest

import numpy as np

from signalwatch.operators.thresholds import _lattice, arl_zero_start, design_for_ic

POINTS = [  # ic -> k, h1, h2 (FIXTURES.md section 3)
    (0.1, 0.14, 0.88, 2.10), (0.2, 0.29, 1.14, 2.56), (0.4, 0.58, 1.44, 3.12),
    (0.8, 1.15, 1.90, 3.70), (1.5, 2.16, 1.88, 3.88), (3.0, 4.33, 1.68, 4.35),
]


@pytest.mark.parametrize("ic,k,h1,h2", POINTS)
def test_fixture_points(ic, k, h1, h2):
    d = design_for_ic(ic)
    assert (round(d["k"], 2), d["h_L1"], d["h_L2"]) == (k, h1, h2)
    assert d["arl_L1"] >= 20 and d["arl_L2"] >= 100


def test_arl_grows_with_h():
    a, q = _lattice(0.61)
    arls = [arl_zero_start(0.42, a, q, j) for j in range(1, 400, 7)]
    assert all(x <= y + 1e-9 for x, y in zip(arls, arls[1:]))


def test_smallest_lattice_point():
    d = design_for_ic(0.42)
    a, q = _lattice(d["k"])
    j = int(round(d["h_L1"] * q))
    assert arl_zero_start(0.42, a, q, j) >= 20 > arl_zero_start(0.42, a, q, j - 1)


def test_missing_or_zero_ic():
    assert design_for_ic(0.0)["h_L1"] is None
    assert design_for_ic(float("nan"))["k"] is None


def test_coarser_step_only_when_a_solve_fails(monkeypatch):
    """A singular system moves on to the next step; size never does."""
    from signalwatch.operators import thresholds
    plain = thresholds.arl_zero_start

    def fails_on_cents(lam, a, q, j):
        if q == 100:
            raise np.linalg.LinAlgError
        return plain(lam, a, q, j)
    monkeypatch.setattr(thresholds, "arl_zero_start", fails_on_cents)
    d = design_for_ic(0.42)
    assert round(d["k"], 1) == 0.6 and d["h_L1"] is not None


def test_threshold_job_on_spark(spark):
    from signalwatch.operators.thresholds import threshold_table
    params = spark.createDataFrame([(0.42,), (0.77,), (0.42,), (None,)], "inControlCount double")
    rows = {r.ic: r for r in threshold_table(params).collect()}
    assert set(rows) == {0.42, 0.77}
    assert rows[0.77].h_L2 == 3.68
