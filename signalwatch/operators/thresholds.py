"""Decision intervals of the Poisson CUSUM for target average run lengths.

Method (Brook & Evans 1972 Markov-chain approximation, exact for integer
counts on a lattice): with k = a/q in lowest terms, the chart lives on the
lattice {0, 1/q, 2/q, ...}. For a decision interval h = j/q the non-alarm
states are 0 .. j-1 (in units of 1/q); from state s a count x moves to
max(0, s + q x - a), and the chart signals when it reaches j or more (the same
``>=`` the chart itself uses). The in-control ARL from a zero start solves
(I - P) L = 1. ARL grows with j, so the smallest j whose ARL reaches the
target is found by doubling then bisection.

k is tried on the steps 0.01, 0.1, 0.2, 0.5 in that order; a step fails when
the solve itself fails (k rounds to 0, or the system is singular), and the next
coarser step is used, never because of the chain's size. Level 1 fixes k; each
level reports the h of its own first successful step.

Spark side: only the distinct in-control means are solved (multiples of 0.01, so
their number follows the largest mean, not the rows); they are spread round-robin
over the cluster's cores and each task solves its share with numpy in
``mapInPandas``. The result is joined back by ic.
"""

from __future__ import annotations

import math
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.params import K_STEPS, L1_ARL, L2_ARL

THRESHOLD_SCHEMA = "ic double, k double, h_L1 double, h_L2 double, arl_L1 double, arl_L2 double"


def _poisson_pmf(lam: float, n: int) -> np.ndarray:
    x = np.arange(n, dtype=float)
    lg = np.array([math.lgamma(v + 1.0) for v in x])
    return np.exp(x * math.log(lam) - lam - lg)


def arl_zero_start(lam: float, a: int, q: int, j: int) -> float:
    """In-control ARL of the chart with k = a/q and h = j/q from S = 0."""
    if j <= 0:
        return 1.0
    xmax = (j - 1 + a) // q + 1          # counts that can keep the chart below j
    pmf = _poisson_pmf(lam, xmax + 1)
    cdf = np.cumsum(pmf)
    s = np.arange(j)[:, None]
    x = np.arange(xmax + 1)[None, :]
    tgt = s + q * x - a                   # target state for each (state, count)
    P = np.zeros((j, j))
    inside = (tgt > 0) & (tgt < j)
    rows = np.broadcast_to(s, tgt.shape)[inside]
    P[rows, tgt[inside]] += np.broadcast_to(pmf[None, :], tgt.shape)[inside]
    # counts that drop the chart to 0: x <= (a - s) / q
    zmax = np.floor((a - np.arange(j)) / q).astype(int)
    P[:, 0] += np.where(zmax >= 0, cdf[np.clip(zmax, 0, xmax)], 0.0)
    L = np.linalg.solve(np.eye(j) - P, np.ones(j))
    return float(L[0])


def _lattice(k: float) -> tuple[int, int]:
    cents = int(round(k * 100))
    g = gcd(cents, 100) or 100
    return cents // g, 100 // g


def design_h(lam: float, k: float, target: float) -> tuple[float, float] | None:
    """Smallest lattice h with ARL >= target for this k, or None when k is not positive or the system is singular."""
    if not (lam > 0) or not (k > 0):
        return None
    a, q = _lattice(k)
    hi = 1
    arl_hi = arl_zero_start(lam, a, q, hi)
    while arl_hi < target:
        hi *= 2
        arl_hi = arl_zero_start(lam, a, q, hi)
    lo = hi // 2                          # ARL(lo) < target (or lo == 0)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        v = arl_zero_start(lam, a, q, mid)
        if v >= target:
            hi, arl_hi = mid, v
        else:
            lo = mid
    return round(hi / q, 6), arl_hi


def _try_design(lam: float, k: float, target: float) -> tuple[float, float] | None:
    try:
        return design_h(lam, k, target)
    except np.linalg.LinAlgError:
        return None


def design_for_ic(ic: float, l1_arl: float = L1_ARL, l2_arl: float = L2_ARL, steps=K_STEPS) -> dict:
    """k, h_L1, h_L2 for one in-control mean (the out-of-control mean is 2 ic)."""
    out = {"ic": ic, "k": None, "h_L1": None, "h_L2": None, "arl_L1": None, "arl_L2": None}
    if ic is None or not (ic > 0) or math.isnan(ic):
        return out
    oc = 2 * ic
    ref = (oc - ic) / (math.log(oc) - math.log(ic))
    ks = [float(np.rint(ref / st) * st) for st in steps]
    for k in ks:
        r = _try_design(ic, k, l1_arl)
        if r is not None:
            out["k"], out["h_L1"], out["arl_L1"] = k, r[0], r[1]
            break
    for k in ks:
        r = _try_design(ic, k, l2_arl)
        if r is not None:
            out["h_L2"], out["arl_L2"] = r[0], r[1]
            break
    return out


def _ship_by_value() -> None:
    """Serialize this module's kernel with the task, so executors need no install of the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def threshold_table(params: DataFrame, l1_arl: float = L1_ARL, l2_arl: float = L2_ARL, steps=K_STEPS,
                    partitions: int | None = None) -> DataFrame:
    """L6 as a Spark job: distinct ic -> (ic, k, h_L1, h_L2) solved in parallel."""
    _ship_by_value()
    ics = params.select(F.col("inControlCount").alias("ic")).filter(F.col("ic").isNotNull()).distinct()
    # A user-numbered round-robin shuffle: the distinct's own exchange would be
    # coalesced by AQE into one task (the table is tiny), serializing every
    # solve. Round-robin spreads the values evenly; Spark sorts before it, so a
    # retried task gets the same rows.
    n = partitions or params.sparkSession.sparkContext.defaultParallelism
    ics = ics.repartition(n)

    def solve(batches):
        for pdf in batches:
            rows = [design_for_ic(float(v), l1_arl, l2_arl, steps) for v in pdf["ic"]]
            yield pd.DataFrame(rows, columns=["ic", "k", "h_L1", "h_L2", "arl_L1", "arl_L2"]).astype("float64")

    return ics.mapInPandas(solve, THRESHOLD_SCHEMA)
