"""Monthly counts, denominators and the complete site x month grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from signalwatch.functions.rounding import round_half_even, round_to_step


def _event_year(ym):
    return F.substring(ym, 1, 4).cast("int")


def period_keys(df: DataFrame, ym: str = "year_month") -> DataFrame:
    """L1 keys: denominator year = Y-1, rate period = '(Y-3)-(Y-1)'."""
    y = _event_year(F.col(ym))
    return df.withColumns({
        "denom_period": y - 1,
        "refrate_period": F.concat((y - 3).cast("string"), F.lit("-"), (y - 1).cast("string")),
    })


def monthly_events(events: DataFrame) -> DataFrame:
    """L1: events per (site, month) with their period keys (partial aggregation map-side)."""
    m = (events.groupBy("Site_Code", "year_month")
         .agg(F.sum("event_count").cast("long").alias("monthly_count")))
    return period_keys(m)


def match_keys(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which a null key matches a null key; the columns of ``left``, then the others of ``right``.

    Still an equi-join for the planner (hashed or sorted by key); rows without a key all share one, so ``right`` should
    have been grouped by the keys.
    """
    named = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(lambda a, b: a & b, (left[c].eqNullSafe(named[f"_right_{c}"]) for c in on))
    return left.join(named, same, how).drop(*(f"_right_{c}" for c in on))


def annual_denominators(denoms: DataFrame, monthly: DataFrame, null_safe: bool = False) -> DataFrame:
    """L2 + C3: mean monthly births per site and year, for the years some event needs (also no year, if ``null_safe``)."""
    needed = monthly.select(F.col("denom_period").alias("Year")).distinct()
    d = match_keys(denoms, needed, ["Year"], "left_semi") if null_safe else denoms.join(needed, "Year", "left_semi")
    return (d.groupBy("Site_Code", "Year")
            .agg(F.avg("Term_Births").alias("Monthly_Term_Births"),
                 F.avg("Term_Live_Births").alias("Monthly_Term_Live_Births")))


def _by_site(df: DataFrame, key: str, value, name: str) -> DataFrame:
    """One row per site with a map key -> value; as long as the calendar."""
    return df.groupBy("Site_Code").agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), value))).alias(name))


def month_grid(monthly: DataFrame, annual: DataFrame, rates: DataFrame, measure: str = "All",
               full_calendar: bool = False, lost: Observation | None = None, year_start: str | None = None) -> DataFrame:
    """L3 + L4 + C5/C6: every site with denominators x every month with an event anywhere, with its
    count (0 where missing), the denominator of year Y-1 and the rate of period '(Y-3)-(Y-1)'.

    Counts by month and denominators by year are gathered per site (both as long as the
    calendar) and looked up when the site's months are exploded, so sites and counts meet
    in one join on the site and the grid itself is never shuffled. The month list is one
    sorted array from a scalar subquery. ``full_calendar`` (N7) uses every month from the
    first to the last month with an event instead, so a month without any event still
    gets rows. The rate table joins on (site, period) when it has a site column, else on
    the period only (national rates).

    ``lost`` watches ``events_without_denominator``, the events of sites that have no denominators and so
    no rows here; ``year_start`` names a column that marks each site's first month of a year.
    """
    if full_calendar:
        first = F.to_date(F.concat(F.min("year_month"), F.lit("-01")))
        last = F.to_date(F.concat(F.max("year_month"), F.lit("-01")))
        seq = F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
        months = monthly.agg(F.transform(seq, lambda d: F.date_format(d, "yyyy-MM")).alias("m"))
    else:
        months = monthly.agg(F.array_sort(F.collect_set("year_month")).alias("m"))
    same_year = lambda m, k: F.substring(m, 1, 4) == F.substring(F.get("m", k - 1), 1, 4)
    months = months.select(F.transform("m", lambda m, k: F.struct(m.alias("year_month"), (~F.coalesce(same_year(m, k), F.lit(False))).alias("first")))).scalar()
    births = F.col("Monthly_Term_Births") if measure == "All" else F.col("Monthly_Term_Live_Births")
    sites = _by_site(annual, "Year", births, "births").join(
        _by_site(monthly, "year_month", F.col("monthly_count"), "counts"), "Site_Code", "full" if lost else "left")
    if lost:
        events = F.aggregate(F.map_values("counts"), F.lit(0).cast("long"), lambda a, n: a + n)
        sites = sites.observe(lost, F.sum(F.when(F.col("births").isNull(), events)).alias("events_without_denominator"))
        sites = sites.filter("births is not null")
    g = period_keys(sites.select("Site_Code", "births", "counts", F.inline(months)))
    g = g.select("Site_Code", "year_month", "refrate_period", *([F.col("first").alias(year_start)] if year_start else []),
                 F.coalesce(F.try_element_at("counts", F.col("year_month")), F.lit(0).cast("long")).alias("numerator"),
                 F.try_element_at("births", F.col("denom_period")).alias("denominator"))
    by_site = "Site_Code" in rates.columns
    r = rates.select(F.col("Year").alias("r_period"), "Ref_Rate", *([F.col("Site_Code").alias("r_site")] if by_site else []))
    cond = F.col("refrate_period") == F.col("r_period")
    g = g.join(r, cond & (F.col("Site_Code") == F.col("r_site")) if by_site else cond, "left")
    return g.select("Site_Code", "year_month", "numerator", "refrate_period", "Ref_Rate",
                    _event_year(F.col("year_month")).alias("Event_Year"), "denominator", *([year_start] if year_start else []))


def null_safe_grid(monthly: DataFrame, annual: DataFrame, rates: DataFrame, measure: str = "All") -> DataFrame:
    """L3 + L4 with blank keys kept (C8): events without a site or a month make a site and a month of their own,
    and a null site, month, year or period matches a null one. Charts need a month, so this grid is for review;
    ``month_grid`` makes the chart's."""
    months = monthly.agg(F.array_sort(F.collect_set(F.struct("year_month"))).alias("m")).scalar()  # a struct, as nulls alone are not collected
    births = F.col("Monthly_Term_Births") if measure == "All" else F.col("Monthly_Term_Live_Births")
    g = annual.select("Site_Code").distinct().select("Site_Code", F.inline(months))
    g = period_keys(match_keys(g, monthly.select("Site_Code", "year_month", "monthly_count"), ["Site_Code", "year_month"]))
    g = match_keys(g, annual.select("Site_Code", F.col("Year").alias("denom_period"), births.alias("denominator")), ["Site_Code", "denom_period"])
    g = match_keys(g, rates.select(F.col("Year").alias("refrate_period"), "Ref_Rate"), ["refrate_period"])
    return g.select("Site_Code", "year_month", F.coalesce("monthly_count", F.lit(0).cast("long")).alias("numerator"), "refrate_period",
                    "Ref_Rate", _event_year(F.col("year_month")).alias("Event_Year"), "denominator")


def site_month_grid(month_rows: DataFrame) -> DataFrame:
    """L3: the grid alone, with its period keys."""
    return period_keys(month_rows.select("Site_Code", "year_month", "numerator"))


def control_parameters(df_for_cusum: DataFrame) -> DataFrame:
    """Per site and year, in-control count ic = round(rate * denominator, 2),
    out-of-control oc = 2 ic, reference value (oc - ic) / (ln oc - ln ic) and
    k = that value rounded to 0.01. ic <= 0 or missing inputs give NULLs."""
    return with_parameters(df_for_cusum.select("Site_Code", "Event_Year", "Ref_Rate", "denominator").distinct())


def in_control(rate: Column, denominator: Column) -> Column:
    """The in-control count of a month."""
    return round_half_even(rate * denominator, 2)


def with_parameters(df: DataFrame) -> DataFrame:
    """The parameters of each row from its own rate and denominator."""
    p = df.withColumn("inControlCount", in_control(F.col("Ref_Rate"), F.col("denominator"))).withColumn("outControlCount", 2 * F.col("inControlCount"))
    ok = F.col("inControlCount") > 0
    ref = F.when(ok, (F.col("outControlCount") - F.col("inControlCount"))
                 / (F.ln(F.col("outControlCount")) - F.ln(F.col("inControlCount"))))
    p = p.withColumn("ref_value_unrounded", ref)
    return p.withColumn("ref_value", round_to_step(F.col("ref_value_unrounded"), 0.01))


def attach_thresholds(df_for_cusum: DataFrame, thresholds: DataFrame | None = None,
                      fixed: tuple | None = None) -> DataFrame:
    """K, h_L1, h_L2 onto every month.

    ``thresholds`` is a table keyed by ic (designed by operators.thresholds, or
    given); ``fixed`` = (h1, h2) uses k = ref_value and literal decision intervals.
    ic and k follow from the row's own rate and denominator, so only the small
    table is joined, and nothing with fixed intervals.
    """
    p = with_parameters(df_for_cusum)
    if fixed is not None:
        known = F.col("ref_value").isNotNull()
        p = p.withColumns({"k": F.col("ref_value"), "h_L1": F.when(known, F.lit(float(fixed[0]))),
                           "h_L2": F.when(known, F.lit(float(fixed[1])))})
    else:
        t = thresholds.select(F.col("ic").alias("t_ic"), "k", "h_L1", "h_L2")
        p = p.join(t, p.inControlCount == t.t_ic, "left")
    return p.select(*df_for_cusum.columns, "k", "h_L1", "h_L2")
