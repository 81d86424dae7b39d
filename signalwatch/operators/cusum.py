"""Poisson CUSUM over every site at once.

E5 is the reference's chart: S_t = max(0, S'_{t-1} + x_t - k_t), where the
carried value S'_{t-1} is 0 if round(S_{t-1}, 6) >= h2_t (the alarm resets the
chart in the month it fires; note the test uses this row's h2) and S_{t-1}
otherwise; the stored statistic is round(S_t, 6), the carried one is not.

The series of a site is one row per month (or day), so its length is bounded by the
calendar, not by the data volume. The fold runs inside the JVM as a
higher-order ``aggregate`` over the site's month-sorted array: one shuffle by
site, no Python, no per-row driver work. A missing k or h2 (missing inputs,
see N6) gives a NULL statistic for that month and restarts the chain at 0.
The accumulator is cast to a nullable array type: inside ``aggregate`` an
``array(0D)`` start value is typed non-nullable and an appended NULL would
silently turn into 0.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.functions.rounding import round6

#: Rows that one inner fold appends to its own array; the outer array then only grows once per block.
BLOCK = 64

_STEP = f"""
flatten(slice(
  aggregate(sequence(0, (size(rows) - 1) div {BLOCK}), CAST(array(array(first)) AS ARRAY<ARRAY<DOUBLE>>), (done, n) ->
    array_append(done, slice(
      aggregate(slice(rows, CAST(n * {BLOCK} + 1 AS INT), {BLOCK}), CAST(array(element_at(element_at(done, -1), -1)) AS ARRAY<DOUBLE>), (acc, r) ->
        array_append(acc,
          CASE WHEN r.k IS NULL OR r.h2 IS NULL THEN CAST(NULL AS DOUBLE)
               ELSE greatest(0D,
                      CASE WHEN bround(coalesce(element_at(acc, -1), 0D), 6) >= r.h2 THEN 0D
                           ELSE coalesce(element_at(acc, -1), 0D) END
                      + r.x - r.k)
          END)),
      2, {BLOCK}))),
  2, size(rows)))
"""


def cusum_reset(df: DataFrame, site: str = "Site_Code", order: str = "year_month", x: str = "numerator",
                k: str = "k", h2: str = "h_L2", out: str = "Cusum_Statistic", start: str | None = None,
                raw: str | None = None) -> DataFrame:
    """E5: CUSUM with reset; returns ``df`` with ``out`` added (one row per input row).

    ``start`` names a column with the unrounded statistic that a site's first row continues from (the same in all of
    the site's rows; 0 without it or where it is NULL); ``raw`` adds the unrounded statistic, from which a later run
    continues. An array is copied by each append, so a series of n rows folds in blocks: n * BLOCK steps of
    copying inside blocks and (n / BLOCK)^2 between them, where one array would take n^2.
    """
    others = [c for c in df.columns if c not in (site, order)]
    packed = F.struct(F.col(order).alias("o"), F.col(x).cast("double").alias("x"),
                      F.col(k).cast("double").alias("k"), F.col(h2).cast("double").alias("h2"),
                      F.struct(*[F.col(c) for c in others]).alias("rest"))
    first = F.first(F.col(start).cast("double")) if start else F.first(F.lit(0.0))
    per_site = df.groupBy(site).agg(F.array_sort(F.collect_list(packed)).alias("rows"), first.alias("first"))
    folded = per_site.select(site, "rows", F.expr(_STEP).alias("s"))
    zipped = folded.select(site, F.explode(F.arrays_zip("rows", "s")).alias("z"))
    return zipped.select(site, F.col("z.rows.o").alias(order),
                         *[F.col(f"z.rows.rest.{c}").alias(c) for c in others],
                         round6(F.col("z.s")).alias(out), *([F.col("z.s").alias(raw)] if raw else []))


def cusum_no_reset(df: DataFrame, site: str = "Site_Code", order: str = "year_month", x: str = "numerator",
                   k: str = "k", out: str = "Cusum_Statistic") -> DataFrame:
    """Clamped cumulative sum without reset, in closed form with two running windows.

    With W_t the running sum of (x - k): S_t = W_t - min(0, min_{i<=t} W_i).
    """
    w = Window.partitionBy(site).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = F.col(x).cast("double") - F.col(k).cast("double")
    tmp = df.withColumn("_w", F.sum(d).over(w))
    tmp = tmp.withColumn("_m", F.min("_w").over(w))
    return tmp.withColumn(out, round6(F.col("_w") - F.least(F.lit(0.0), F.col("_m")))).drop("_w", "_m")
