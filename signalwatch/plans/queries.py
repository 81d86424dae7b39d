"""Registered queries: one per operator row of the coverage checklist.

Each callable takes (spark, sf_dir) and returns a DataFrame over the whole
test tables. Column names equal those of the SQL in ``plans.oracle``.
Doubles built from sums whose order may differ between engines are rounded
to 6 digits on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.functions.dates import parse_date_any
from signalwatch.functions.rounding import round6
from signalwatch.operators import carry, clean, cusum, grid, workdays
from signalwatch.plans.testbed_plan import FIXED_H, refreshed, shared_flows, signal_from_source, source_flow
from signalwatch.session import RunFolder
from signalwatch.sources import testbed
from signalwatch.sources.commits import RunLog
from signalwatch.sources.readers import read_denoms, read_events, read_register, read_table, read_text
from signalwatch.sources.sinks import write_csv, write_dated, write_parquet, write_register, write_table

Query = Callable[[SparkSession, str], DataFrame]
START_DATE = dt.date(1996, 1, 1)
FLAGS = ["Level1_6months", "Level2_6months", "Level1_12months", "Level2_12months"]


def _src(spark, d):
    """Persisted cleaning flow (intermediate DISTINCTs skipped; final outputs equal)."""
    return shared_flows(spark, d)["src"]


def _ref_src(spark, d):
    """Cleaning flow with every DISTINCT of the reference, for the intermediate views."""
    return source_flow(spark, d, fast=False, persist=False)


def _sig(spark, d):
    return shared_flows(spark, d)["fixed"]


def _r(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: round6(F.col(c)) for c in cols})


def _k2(df: DataFrame) -> DataFrame:
    return df.withColumn("k", F.bround(F.col("k"), 2))


Q: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# ------------------------------------------------------------ cleaning (J, K)
@query("clean_births")
def q_clean_births(spark, d):
    """J1 with a start date, as a run that only wants later births sets it."""
    return clean.clean_births(_ref_src(spark, d).raw, START_DATE)


@query("clean_births_all")
def q_clean_births_all(spark, d):
    """J1 over all births, without a start date."""
    return clean.clean_births(_ref_src(spark, d).raw)


@query("outcome_class")
def q_outcome_class(spark, d):
    return _ref_src(spark, d).classified


@query("single_site_trusts")
def q_single_site_trusts(spark, d):
    return _ref_src(spark, d).single_site


@query("clean_single_site")
def q_clean_single_site(spark, d):
    return _ref_src(spark, d).single_mapped


@query("clean_mergers")
def q_clean_mergers(spark, d):
    return _ref_src(spark, d).merged


@query("clean_postcode")
def q_clean_postcode(spark, d):
    return _ref_src(spark, d).postcode_mapped


@query("clean_trust")
def q_clean_trust(spark, d):
    return _ref_src(spark, d).with_trust


@query("clean_current_sites")
def q_clean_current_sites(spark, d):
    return clean.current_only(_src(spark, d).with_trust, dedupe=True)


@query("events_extract")
def q_events_extract(spark, d):
    return _src(spark, d).events


@query("births_by_month")
def q_births_by_month(spark, d):
    return _src(spark, d).births_by_month.select("Site_Code", "ods_code", "Period", "Term_Births")


@query("stillbirths_by_month")
def q_stillbirths_by_month(spark, d):
    return (_src(spark, d).births_by_month.filter(F.col("Term_Stillbirths") > 0)
            .select("Site_Code", "ods_code", "Period", "Term_Stillbirths"))


@query("live_births")
def q_live_births(spark, d):
    return _src(spark, d).all_births


@query("denoms_complete")
def q_denoms_complete(spark, d):
    return _src(spark, d).denoms


@query("unmapped_sites")
def q_unmapped_sites(spark, d):
    return _src(spark, d).unmapped


@query("unmapped_totals")
def q_unmapped_totals(spark, d):
    return _src(spark, d).unmapped_totals


@query("new_sites_check")
def q_new_sites_check(spark, d):
    return _src(spark, d).new_sites


@query("new_sites_count")
def q_new_sites_count(spark, d):
    return _src(spark, d).new_sites_count


@query("quality_gates")
def q_quality_gates(spark, d):
    return _src(spark, d).gates


@query("mapping_gates")
def q_mapping_gates(spark, d):
    return _src(spark, d).mapping_gates


# ----------------------------------------------------------- grid
@query("monthly_events")
def q_monthly_events(spark, d):
    return _sig(spark, d).monthly


@query("period_keys")
def q_period_keys(spark, d):
    return _sig(spark, d).monthly.select("year_month", "denom_period", "refrate_period").distinct()


@query("distinct_periods")
def q_distinct_periods(spark, d):
    return _sig(spark, d).monthly.select("year_month").distinct()


@query("denoms_needed_years")
def q_denoms_needed_years(spark, d):
    f = _sig(spark, d)
    needed = f.monthly.select(F.col("denom_period").alias("Year")).distinct()
    return f.denoms_in.join(needed, "Year", "left_semi").select("Site_Code", "Period", "Term_Births",
                                                                "Term_Live_Births", "Year")


@query("annual_denominators")
def q_annual_denominators(spark, d):
    return _sig(spark, d).annual


@query("site_month_grid")
def q_site_month_grid(spark, d):
    return _sig(spark, d).grid


@query("denominator_join")
def q_denominator_join(spark, d):
    return _r(_sig(spark, d).df_for_cusum, "Ref_Rate", "denominator")


@query("denominator_live")
def q_denominator_live(spark, d):
    """L4 with live births as the denominator."""
    f = signal_from_source(_src(spark, d), FIXED_H, True, measure="Live")
    return _r(f.df_for_cusum, "Ref_Rate", "denominator")


@query("grid_null_keys")
def q_grid_null_keys(spark, d):
    """The grid of events and denominators some of which lack a site, a month or a year; blank keys match blank ones."""
    f = _sig(spark, d)
    events, denoms = testbed.with_blank_keys(f.events_in, f.denoms_in)
    monthly = grid.monthly_events(events)
    g = grid.null_safe_grid(monthly, grid.annual_denominators(denoms, monthly, null_safe=True), f.rates)
    return _r(g, "Ref_Rate", "denominator")


@query("cusum_parameters")
def q_cusum_parameters(spark, d):
    c = _sig(spark, d).control
    return c.select("Site_Code", "Event_Year", F.bround("Ref_Rate", 9).alias("Ref_Rate"),
                    round6(F.col("denominator")).alias("denominator"), "inControlCount", "outControlCount",
                    round6(F.col("ref_value_unrounded")).alias("ref_value_unrounded"),
                    F.bround("ref_value", 2).alias("ref_value"))


@query("threshold_join")
def q_threshold_join(spark, d):
    w = _sig(spark, d).with_thresholds
    return _k2(w.select("Site_Code", "year_month", "numerator", "Event_Year", "k", "h_L1", "h_L2"))


@query("threshold_table")
def q_threshold_table(spark, d):
    """The ARL design per distinct in-control mean, on the production steps and targets."""
    t = _k2(shared_flows(spark, d)["designed"].threshold_table)
    return t.withColumns({c: F.bround(c, 4) for c in ("arl_L1", "arl_L2")})


@query("threshold_half_step")
def q_threshold_half_step(spark, d):
    """The ARL design on the coarsest step with short targets, where SQL can sum the survival chances."""
    from signalwatch.operators.thresholds import threshold_table
    return threshold_table(_sig(spark, d).control, 5, 10, (0.5,)).select("ic", "k", "h_L1", "h_L2")


@query("signal_gates")
def q_signal_gates(spark, d):
    """The signal gates on events some of which have a second row without a month."""
    return signal_from_source(_src(spark, d), FIXED_H, True, unkeyed=True).signal_gates


# ------------------------------------------------------------- chart
@query("cusum_reset")
def q_cusum_reset(spark, d):
    c = _sig(spark, d).cusum
    return _k2(c.select("Site_Code", "year_month", "numerator", "k", "h_L2", "Cusum_Statistic"))


@query("cusum_no_reset")
def q_cusum_no_reset(spark, d):
    w = _sig(spark, d).with_thresholds.select("Site_Code", "year_month", "numerator", "k")
    return _k2(cusum.cusum_no_reset(w))


@query("signal_level")
def q_signal_level(spark, d):
    return _sig(spark, d).levels.select("Site_Code", "year_month", "numerator", "Cusum_Statistic", "h_L1", "h_L2",
                                        "Level_of_Signal", "Reset_Flag")


@query("date_labels")
def q_date_labels(spark, d):
    lv = _sig(spark, d).levels
    first = F.to_date(F.concat(F.col("year_month"), F.lit("-01")))
    return lv.select("Site_Code", "year_month", first.alias("month_start"),
                     F.add_months(first, 1).alias("next_month_start"), F.last_day(first).alias("month_end"),
                     "Cusum_Period", F.date_add("Cusum_Period", 1).alias("reset_date"), "Date_of_signal")


@query("event_tooltip_month")
def q_event_tooltip_month(spark, d):
    from signalwatch.operators.lines import event_tooltip
    from signalwatch.params import MONTH_LABELS
    return event_tooltip(_sig(spark, d).events, "year_month", MONTH_LABELS, "Events_Desc")


@query("signal_recency")
def q_signal_recency(spark, d):
    return _sig(spark, d).recency.select("Site_Code", "year_month", "Cusum_Period", "Level_of_Signal", *FLAGS)


@query("reset_rows")
def q_reset_rows(spark, d):
    return _sig(spark, d).resets


@query("threshold_rows")
def q_threshold_rows(spark, d):
    return _sig(spark, d).threshold_lines


@query("line_parts")
def q_line_parts(spark, d):
    return _sig(spark, d).lines.filter(F.col("Line_Type") == "CUSUM")


@query("signal_lines")
def q_signal_lines(spark, d):
    return _sig(spark, d).lines


# ------------------------------------------------- incremental refresh
@query("refresh_chart")
def q_refresh_chart(spark, d):
    """The chart after a second run that went on from the first one's state."""
    c = carry.current(spark, refreshed(spark, d), "chart")
    return _k2(c.select("Site_Code", "year_month", "numerator", "k", "h_L2", "Cusum_Statistic"))


@query("refresh_line")
def q_refresh_line(spark, d):
    """The daily line after a second run that went on from the first one's state."""
    return _r(carry.current(spark, refreshed(spark, d), "line"), "cmltv_excess_events")


@query("refresh_sites")
def q_refresh_sites(spark, d):
    """Which sites the second run continued (the others had late events), and their last closed month."""
    s = carry.current_state(spark, refreshed(spark, d))
    return s.select("Site_Code", "upto", (F.col("since") < F.col("run_date")).alias("continued"))


# ------------------------------------------------------- daily line
@query("event_tooltip_day")
def q_event_tooltip_day(spark, d):
    return _sig(spark, d).daily.select("Site_Code", "test_date", "Event_Type")


@query("daily_events")
def q_daily_events(spark, d):
    return _sig(spark, d).daily


@query("daily_expand")
def q_daily_expand(spark, d):
    from signalwatch.operators.vlad import daily_expand
    e = daily_expand(_sig(spark, d).cusum_out)
    return e.select("Site_Code", round6(F.col("denominator")).alias("denominator"),
                    F.bround("event_rate", 9).alias("event_rate"), "Signal_Flag", "Date_VLAD")


@query("vlad_daily")
def q_vlad_daily(spark, d):
    return _r(_sig(spark, d).vlad, "cmltv_excess_events")


@query("vlad_sites")
def q_vlad_sites(spark, d):
    return _r(_sig(spark, d).vlad_named, "Excess_Events")


@query("final_signals")
def q_final_signals(spark, d):
    return _r(_sig(spark, d).final, "Excess_Events")


@query("final_designed")
def q_final_designed(spark, d):
    """The final table with a threshold table for each in-control count, joined as a designed one is."""
    return _r(shared_flows(spark, d)["given"].final, "Excess_Events")


@query("final_production")
def production_final(spark, d):
    """The final table with ARL-designed thresholds (the production setting); the flagship query."""
    return _r(shared_flows(spark, d)["designed"].final, "Excess_Events")


# ------------------------------------------------------- register
@query("signal_register")
def q_signal_register(spark, d):
    return _sig(spark, d).register


@query("register_compare")
def q_register_compare(spark, d):
    return _sig(spark, d).compare


@query("project_rename")
def q_project_rename(spark, d):
    return _sig(spark, d).new_register


@query("final_notified")
def q_final_notified(spark, d):
    return _r(_sig(spark, d).notified, "Excess_Events")


@query("working_day_due")
def q_working_day_due(spark, d):
    f = _sig(spark, d)
    # written, a row a day: the calendar reads them for its years, its ends, its starts and the result
    days = RunFolder(spark).keep(f.final.select(F.col("Date").alias("start_date")).distinct(), "start_dates")
    holidays = workdays.bank_holidays(workdays.years_between(days, "start_date", 1))
    return workdays.add_working_days(days, "start_date", f.p.checklist_working_days, holidays, "due_date")


@query("register_dropped")
def q_register_dropped(spark, d):
    return _sig(spark, d).dropped


@query("register_lowered")
def q_register_lowered(spark, d):
    return _sig(spark, d).lowered


@query("run_summary")
def q_run_summary(spark, d):
    return _sig(spark, d).summary


# ------------------------------------------------- readers and sinks
def _folder(spark) -> str:
    return RunFolder(spark).path


@query("csv_events")
def q_csv_events(spark, d):
    """The events as CSV, blank rows among them, read back by header name."""
    events = _src(spark, d).events
    blank = spark.range(3).select(*[F.lit(None).cast(t).alias(c) for c, t in events.dtypes])
    path = _folder(spark)
    write_csv(events.unionByName(blank), path)
    return read_events(spark, path)


@query("catalog_events")
def q_catalog_events(spark, d):
    """A2: the events and the providers as tables of the catalog, read by name and joined again."""
    src, run = _src(spark, d), RunFolder(spark)
    tables = {"events": src.events, "providers": src.provider}
    for name, df in tables.items():
        write_table(df, f"{run.name}_{name}", f"{run.path}/{name}")
    events, providers = (read_table(spark, f"{run.name}_{name}", dict(df.dtypes)) for name, df in tables.items())
    names = providers.select("Site_Code", F.col("Trust_Code").alias("trust")).distinct()
    return events.join(names, "Site_Code", "left").groupBy("Site_Code", "trust", "outcome").agg(F.sum("event_count").alias("events"))


@query("csv_denoms")
def q_csv_denoms(spark, d):
    """A1, A5: the denominators as CSV and back."""
    path = _folder(spark)
    write_csv(_src(spark, d).denoms, path)
    return read_denoms(spark, path)


@query("parquet_final")
def q_parquet_final(spark, d):
    """The final table as parquet and back."""
    path = _folder(spark)
    write_parquet(_r(_sig(spark, d).final, "Excess_Events"), path)
    return spark.read.parquet(path)


@query("csv_register")
def q_csv_register(spark, d):
    """The register compare as CSV parts, from its own partitions, and back."""
    path = _folder(spark)
    write_csv(_sig(spark, d).compare, path)
    return read_text(spark, path).withColumns({"Email_Trust": F.col("Email_Trust").cast("int"), "Date_Email": parse_date_any("Date_Email")})


@query("register_history")
def q_register_history(spark, d):
    """Two runs' registers under their dates; what the run of each date and a later one would read."""
    flow, path = _sig(spark, d), _folder(spark)
    earlier = flow.p.run_date - dt.timedelta(days=14)
    write_register(flow.old_register, path, earlier)
    write_register(flow.new_register, path, flow.p.run_date)
    asof = [flow.p.run_date, flow.p.run_date + dt.timedelta(days=7)]
    first, second = (read_register(spark, path, day).withColumn("read_on", F.lit(day)) for day in asof)
    return first.unionByName(second)


@query("committed_register")
def q_committed_register(spark, d):
    """The register of the newest finished run; a later one has written its outputs but not its commit."""
    flow, log = _sig(spark, d), RunLog(spark, _folder(spark))
    for days, reg, done in ((14, flow.old_register, True), (7, flow.new_register, True), (0, flow.new_register.limit(0), False)):
        day = flow.p.run_date - dt.timedelta(days=days)
        run = log.start(day)
        write_parquet(reg, log.path(run, "register"))
        if done:
            log.commit(run, day, ["register"])
    return log.read("register")


@query("dated_signals")
def q_dated_signals(spark, d):
    """The day's signals as a dated snapshot; a second write of the day replaces only that day."""
    flow, path = _sig(spark, d), _folder(spark)
    write_dated(flow.register.limit(0), path, flow.p.run_date)
    write_dated(flow.register, path, flow.p.run_date - dt.timedelta(days=7))
    write_dated(flow.register, path, flow.p.run_date)
    write_dated(flow.register, path, flow.p.run_date)
    return spark.read.parquet(path)


@query("parse_dates")
def q_parse_dates(spark, d):
    """I4 on text dates built from the ship dates in both accepted formats."""
    from signalwatch.sources.testbed import table
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("s"))
    txt = F.when(F.col("l_orderkey") % 2 == 0, F.date_format("s", "yyyy-MM-dd")).otherwise(
        F.date_format("s", "dd/MM/yyyy"))
    return li.select("l_orderkey", "l_linenumber", txt.alias("raw_text"), parse_date_any(txt).alias("parsed"))


def queries() -> dict[str, Query]:
    return dict(Q)


# keys whose result has no SQL counterpart (rows-only check)
NO_ORACLE: set[str] = set()

__all__ = ["queries", "NO_ORACLE"]
