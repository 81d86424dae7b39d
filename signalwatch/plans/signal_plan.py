"""Events + denominators + rates -> chart table, register and message (3.2, 3.3)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from signalwatch.operators import cusum, grid, lines, register, thresholds, vlad, workdays
from signalwatch.functions.dates import month_start, third_last_day
from signalwatch.operators.quality import observed_row
from signalwatch.params import SignalParams
from signalwatch.session import RunFolder, figures

#: Tables that are bucketed by site: what is joined, grouped and windowed by site later needs no shuffle.
BY_SITE = dict.fromkeys(["event_months", "annual", "month_grid", "chart_months", "event_days"], "Site_Code")


def _no_key():
    return F.col("Site_Code").isNull() | F.col("year_month").isNull()


class SignalFlow:
    """Lazy stages of the signal pipeline; each property is one reference table.

    ``old_register`` is the last run's register, or a callable that derives it
    from this flow (used by the test tables), or None for a first run.

    ``threshold_table`` is a given table (ic, k, h_L1, h_L2) instead of the design.

    ``persist=True`` writes four tables to a run folder in the shared checkpoint
    folder: the events summed by (site, day, month, outcome), the only scan of the
    events; the month grid with denominators and rates (input of the parameters, the
    threshold design and the fold); the monthly chart rows (input of the line
    set, the daily line and the register) and the final table with its
    notification columns (the run's output, read again by the summary; a batch run
    writes it straight to its place). The writes also cut the lineage for executor loss.
    The tables of ``BY_SITE`` are bucketed by site when they are written, by the month at most; the
    fold, the line set and the daily line, thirty times as long, then stay on that partitioning.
    """

    def __init__(self, events: DataFrame, denoms: DataFrame, rates: DataFrame, provider: DataFrame,
                 params: SignalParams, old_register=None, holidays: DataFrame | None = None,
                 persist: bool = True, threshold_table: DataFrame | None = None):
        self.events_in, self.denoms_in, self.rates, self.provider = events, denoms, rates, provider
        self.p = params
        self.persist = persist
        self._old = old_register
        self._holidays = holidays
        self._given = threshold_table
        self.folder = RunFolder(events.sparkSession) if persist else None

    def _keep(self, df: DataFrame, name: str, watched=None) -> DataFrame:
        return self.folder.keep(df, name, watched, BY_SITE.get(name)) if self.persist else df

    # --- grid and parameters ------------------------------------------------
    @cached_property
    def base(self) -> DataFrame:
        """Events by (site, day, month, outcome); everything later reads this instead of the events."""
        keys = ["Site_Code", "test_date", "year_month", "outcome"]
        return self._keep(self.events_in.groupBy(*keys).agg(F.sum("event_count").alias("event_count")), "event_days",
                          {"events_without_key": F.sum(F.when(_no_key(), F.col("event_count")))})

    @cached_property
    def events(self) -> DataFrame:
        """The events that can be charted; those without a site or month are counted by ``signal_gates``."""
        return self.base.dropna(subset=["Site_Code", "year_month"])

    @cached_property
    def monthly(self) -> DataFrame:          # L1
        return self._keep(grid.monthly_events(self.events), "event_months")

    @cached_property
    def annual(self) -> DataFrame:           # L2
        return self._keep(grid.annual_denominators(self.denoms_in, self.monthly), "annual")

    @cached_property
    def grid(self) -> DataFrame:             # L3
        return grid.site_month_grid(self.df_for_cusum)

    @cached_property
    def df_for_cusum(self) -> DataFrame:     # L4
        lost = Observation() if self.persist else None
        df = grid.month_grid(self.monthly, self.annual, self.rates, self.p.selected_measure, self.p.full_month_calendar, lost,
                             "_year_start" if self.persist else None)
        if not self.persist:
            return df
        ic = grid.in_control(F.col("Ref_Rate"), F.col("denominator"))
        df = self._keep(df, "month_grid", {"site_years_without_design": F.count_if(F.col("_year_start") & (ic.isNull() | (ic <= 0)))})
        seen = figures(lost)
        self.folder.seen["events_without_denominator"] = seen["events_without_denominator"] if seen else self._lost_events().first()[0]
        return df.drop("_year_start")

    @cached_property
    def control(self) -> DataFrame:          # L5
        return grid.control_parameters(self.df_for_cusum)

    @cached_property
    def threshold_table(self) -> DataFrame:  # L6
        if self._given is not None:
            return self._given
        return thresholds.threshold_table(self.control, self.p.l1_arl, self.p.l2_arl, self.p.k_steps)

    def use_thresholds(self, given: DataFrame) -> None:
        """A given threshold table instead of the design."""
        self._given = given

    @cached_property
    def with_thresholds(self) -> DataFrame:  # L7
        if self.p.fixed_thresholds is not None:
            return grid.attach_thresholds(self.df_for_cusum, fixed=self.p.fixed_thresholds)
        return grid.attach_thresholds(self.df_for_cusum, thresholds=self.threshold_table)

    @cached_property
    def signal_gates(self) -> DataFrame:     # N6, N8 reported instead of stopping the run
        """One row: site-years without a design (missing rate or denominator, ic <= 0), chart
        months without thresholds, events at sites without denominators, and events
        without a site or a month. A flow that writes its tables has counted them while it
        wrote the events by day, the month grid and the chart months (a rate table has one row
        for each period)."""
        names = ["site_years_without_design", "months_without_threshold", "events_without_denominator", "events_without_key"]
        if self.persist:
            self.base, self.df_for_cusum, self.cusum_out  # written by now
            return observed_row(self.events_in.sparkSession, self.folder.seen, dict.fromkeys(names, "long"))
        missing = self.with_thresholds.agg(
            F.count_if(F.col("k").isNull() | F.col("h_L2").isNull())).scalar()
        lost = self._lost_events().scalar()
        unkeyed = self.base.filter(_no_key()).agg(F.coalesce(F.sum("event_count"), F.lit(0)).cast("long")).scalar()
        return self.control.agg(
            F.count_if(F.col("inControlCount").isNull() | (F.col("inControlCount") <= 0)).alias(names[0])
        ).select("*", missing.alias(names[1]), lost.alias(names[2]), unkeyed.alias(names[3]))

    def _lost_events(self) -> DataFrame:
        sites = self.annual.select("Site_Code").distinct()
        return self.events.join(sites, "Site_Code", "left_anti").agg(F.coalesce(F.sum("event_count"), F.lit(0)).cast("long"))

    # --- chart ---------------------------------------------------------------
    @cached_property
    def cusum(self) -> DataFrame:            # L8
        return cusum.cusum_reset(self.with_thresholds)

    @cached_property
    def levels(self) -> DataFrame:           # L9, L10
        return lines.chart_dates(lines.signal_level(self.cusum))

    @cached_property
    def with_tooltip(self) -> DataFrame:     # L11
        return lines.with_month_tooltip(self.levels, self.events)

    @cached_property
    def latest_chart_date(self):
        """Chart date of the newest grid month. The grid's months are exactly the
        months of the monthly counts, so this reads one small aggregate instead
        of the whole chart."""
        newest = self.monthly.agg(F.max("year_month")).scalar()   # also the last month of a full calendar
        return third_last_day(month_start(newest))

    @cached_property
    def recency(self) -> DataFrame:          # L12
        return lines.recency_flags(self.with_tooltip, self.latest_chart_date)

    @cached_property
    def cusum_out(self) -> DataFrame:
        df = lines.cusum_output(self.recency)
        # the statistic is missing just where k or the level-2 interval is
        return self._keep(df, "chart_months", {"months_without_threshold": F.count_if(F.col("Cusum_Statistic").isNull())})

    @cached_property
    def resets(self) -> DataFrame:           # L13
        return lines.reset_rows(self.cusum_out)

    @cached_property
    def threshold_lines(self) -> DataFrame:  # L14
        return lines.threshold_rows(self.cusum_out)

    @cached_property
    def lines(self) -> DataFrame:            # L15
        return lines.line_set(self.cusum_out, self.resets, self.threshold_lines)

    # --- daily line ------------------------------------------------------------
    @cached_property
    def daily(self) -> DataFrame:            # L16
        return vlad.daily_events(self.events, by_site=self.persist)

    @cached_property
    def vlad(self) -> DataFrame:             # L17
        return vlad.vlad(self.cusum_out, self.daily)

    @cached_property
    def vlad_named(self) -> DataFrame:       # L18
        return vlad.with_site_names(self.vlad, self.provider)

    @cached_property
    def final(self) -> DataFrame:            # L19
        return vlad.final_table(self.cusum_out, self.daily, self.lines, self.provider)

    # --- register ----------------------------------------------------------------
    @cached_property
    def chart_named(self) -> DataFrame:
        """Monthly chart rows with site and trust names: the CUSUM rows of the final table."""
        p = self.provider.select(F.col("Site_Code").alias("ps_site"), "Site_Name",
                                 F.col("Trust_Code").alias("ODS_Code"), F.col("Trust_Name").alias("ODS_Name"))
        c = self.cusum_out
        return c.join(p, c.Site_Code == p.ps_site, "left").drop("ps_site")

    @cached_property
    def register(self) -> DataFrame:         # L20
        return register.signal_register(self.chart_named)

    @property
    def has_register(self) -> bool:
        return self._old is not None

    def use_register(self, old: DataFrame | None) -> None:
        """The last run's register; before anything that compares with it is read."""
        self._old = old

    @cached_property
    def old_register(self) -> DataFrame:
        if callable(self._old):
            return self._old(self)
        if self._old is None:
            return self.register.limit(0).withColumn("Date_Email", F.lit(None).cast("date"))
        return self._old

    @cached_property
    def compare(self) -> DataFrame:          # L21
        return register.register_compare(self.register, self.old_register, self.p.run_date)

    @cached_property
    def new_register(self) -> DataFrame:
        return register.new_register(self.compare)

    @cached_property
    def formatted(self) -> DataFrame:
        return register.compare_formatted(self.compare)

    @cached_property
    def holidays(self) -> DataFrame:
        if self._holidays is not None:
            return self._holidays
        # years of the notification dates and one more, as a due date may fall into the next year
        return workdays.bank_holidays(workdays.years_between(self.compare, "Date_Email", 1))

    def notified_plan(self) -> DataFrame:    # L22, L23
        """The final table with notification columns; these join the chart rows, a month each, not the daily table."""
        told = register.with_notifications(self.lines, self.formatted, self.holidays, self.p.checklist_working_days)
        if self.persist:  # back on the buckets' partitioning, so that the daily rows stay where they are
            told = told.repartition(self.folder.buckets, "Site_Code")
        return vlad.final_table(self.cusum_out, self.daily, told, self.provider, register.NOTIFICATION_COLS)

    @cached_property
    def notified(self) -> DataFrame:
        return self._keep(self.notified_plan(), "final_table")

    def write_final(self, path: str) -> None:
        """Write the final table to its place; what reads it later (the summary) reads it there."""
        plan = self.notified_plan()
        plan.write.mode("overwrite").parquet(path)
        self.notified = plan.sparkSession.read.parquet(path)

    @cached_property
    def dropped(self) -> DataFrame:          # L24
        return register.register_dropped(self.old_register, self.register)

    @cached_property
    def lowered(self) -> DataFrame:          # L25
        return register.register_lowered(self.dropped, self.cusum_out)

    @cached_property
    def summary(self) -> DataFrame:          # L26
        return register.run_summary(self.notified, self.formatted, self.lowered)
