"""Signal register kept from run to run."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.functions.text import english_list
from signalwatch.operators.workdays import add_working_days


def signal_register(final: DataFrame) -> DataFrame:
    """This run's signals, ID = site-'Month yyyy'-level.

    ``final`` is the final table or any table holding its CUSUM rows with the
    same columns (the monthly chart rows with site names give the same rows:
    each CUSUM row sits on exactly one day of its month's daily line)."""
    s = final.filter(F.col("Level_of_Signal").isin(1, 2) & (F.col("Line_Type") == "CUSUM"))
    return s.select(F.concat_ws("-", "Site_Code", "Date_of_signal", F.col("Level_of_Signal").cast("string")).alias("ID"),
                    "Site_Code", "Site_Name", "ODS_Code", "ODS_Name")


def register_compare(new: DataFrame, old: DataFrame, run_date: _dt.date) -> DataFrame:
    """A signal not in the old register is notified today; others keep their date."""
    o = old.select(F.col("ID").alias("o_id"), F.col("Site_Code").alias("Site_Code_New"),
                   F.col("Date_Email").alias("o_date"))
    j = new.join(o, new.ID == o.o_id, "left")
    is_new = F.col("Site_Code_New").isNull()
    return j.select("ID", "Site_Code", "Site_Name", "ODS_Code", "ODS_Name",
                    F.when(is_new, 1).otherwise(0).alias("Email_Trust"),
                    F.when(is_new, F.lit(run_date)).otherwise(F.col("o_date")).alias("Date_Email"))


def new_register(compare: DataFrame) -> DataFrame:
    """The register written for the next run."""
    return compare.select("ID", "Site_Code", "Site_Name", "ODS_Code", "ODS_Name", "Date_Email")


def id_parts(id_col: str = "ID", site_col: str = "Site_Code"):
    """(month label, level) of an ID 'site-Month yyyy-level', cut with the known site
    code rather than split on '-', so a site code containing '-' still parses (N16)."""
    i, site = F.col(id_col), F.col(site_col)
    level = F.substring_index(i, "-", -1)
    start = F.length(site) + 2
    label = F.substring(i, start, F.length(i) - F.length(site) - F.length(level) - 2)
    return label, level


def compare_formatted(compare: DataFrame) -> DataFrame:
    """Per signal: site, month label, site name, notify flag and date."""
    label, _ = id_parts()
    return compare.select("Site_Code", label.alias("Date_of_signal"), "Site_Name", "Email_Trust", "Date_Email")


NOTIFICATION_COLS = ["Email_Trust", "Date_Email", "Date_Checklist"]


def with_notifications(final: DataFrame, formatted: DataFrame, holidays: DataFrame, n: int = 8) -> DataFrame:
    """L22 + L23: notify flag and date on the signal's own row (never on reset rows),
    and the checklist due date n working days after the notification.

    ``final`` is the final table or the chart rows it is made of. A signal is one site and month, so these two join it; a site without a name
    keeps its notification. The due date is worked out on the small per-signal table first, so the
    large final table is joined once.
    """
    f = add_working_days(formatted, "Date_Email", n, holidays, "due")
    f = f.select(F.col("Site_Code").alias("f_site"), F.col("Date_of_signal").alias("f_dos"),
                 F.col("Email_Trust").alias("f_email"),
                 F.col("Date_Email").alias("f_date"), F.col("due").alias("f_due"))
    cond = (final.Site_Code == f.f_site) & (final.Date_of_signal == f.f_dos)
    j = final.join(f, cond, "left")
    not_reset = F.col("Reset_Flag") != "Reset"
    return j.select(*[F.col(c) for c in final.columns],
                    F.when((F.col("f_email") == 1) & not_reset, 1).otherwise(0).alias("Email_Trust"),
                    F.when(not_reset, F.col("f_date")).alias("Date_Email"),
                    F.when(not_reset, F.col("f_due")).alias("Date_Checklist"))


def register_dropped(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old signals without a current one, ID split into its parts."""
    gone = old.join(new.select("ID"), "ID", "left_anti")
    label, level = id_parts()
    return gone.select("ID", "Site_Code", label.alias("Date_of_signal"), level.alias("Level_of_Signal_Old"))


def register_lowered(dropped: DataFrame, final: DataFrame) -> DataFrame:
    """Vanished signals whose month now stands at a lower level (reset rows out).

    Only rows whose month label matches can join, i.e. the CUSUM and reset rows
    of the final table; the monthly chart rows are therefore an equivalent,
    much smaller ``final``."""
    f = final.select(F.col("Site_Code").alias("f_site"), F.col("Date_of_signal").alias("f_dos"),
                     "Reset_Flag", "Level_of_Signal")
    j = dropped.join(f, (dropped.Site_Code == f.f_site) & (dropped.Date_of_signal == f.f_dos), "left")
    j = j.filter(F.col("Reset_Flag") != "Reset")
    return (j.select("Site_Code", "Date_of_signal",
                     F.col("Level_of_Signal_Old").cast("double").alias("Level_of_Signal_Old"),
                     F.col("Level_of_Signal").cast("double").alias("Level_of_Signal_New"))
            .filter(F.col("Level_of_Signal_New") < F.col("Level_of_Signal_Old")))


def run_summary(final: DataFrame, formatted: DataFrame, lowered: DataFrame) -> DataFrame:
    """One row with the latest event date, the number of new and of lowered
    signals, the names of the sites with new signals and the message text.

    Every figure is a global aggregate (scalar subquery). The name list is the
    notification's own content: one name per new signal (the code of a site
    without a name), in site and month order; the table of new signals is written
    besides, one row per signal. Without any event the date reads "none".
    """
    latest = final.filter(F.col("Event_Type").isNotNull()).agg(F.max("Date")).scalar()
    n_low = lowered.agg(F.count(F.lit(1))).scalar()
    new = formatted.filter(F.col("Email_Trust") == 1)
    order_key = F.struct("Site_Code", F.try_to_date(F.concat(F.lit("1 "), F.col("Date_of_signal")), "d MMMM yyyy"),
                         F.coalesce("Site_Name", "Site_Code").alias("Site_Name"))
    agg = new.agg(F.count(F.lit(1)).alias("Number_new_signals"),
                  F.transform(F.array_sort(F.collect_list(order_key)), lambda s: s["Site_Name"]).alias("_names"))
    names = F.when(F.col("Number_new_signals") == 0, F.lit("")).otherwise(
        F.concat(F.lit(" ("), english_list(F.col("_names")), F.lit(")")))
    base = F.concat(F.lit("Signal run finished; events up to "), F.coalesce(F.date_format(latest, "yyyy-MM-dd"), F.lit("none")),
                    F.lit("; new signals: "), F.col("Number_new_signals").cast("string"), F.col("New_Site_Names"), F.lit("."))
    low = F.concat(F.lit(" Signals now at a lower level: "), n_low.cast("string"), F.lit("."))
    out = agg.select(latest.alias("Latest_Date"), "Number_new_signals", n_low.alias("Number_lower_signals"),
                     names.alias("New_Site_Names"))
    return out.withColumn("Message", F.when(F.col("Number_lower_signals") == 0, base)
                          .otherwise(F.concat(base, low)))
