"""Birth-record cleaning (J1-J9): raw records -> current-site births and events.

Each operator is DataFrame -> DataFrame and triggers no action. Reference
tables (provider sites, mergers, postcode map) are joined without hints: the
planner broadcasts them when their statistics are under the broadcast
threshold and sort-merges (with AQE skew splitting) when they are not.

``dedupe`` switches the DISTINCT of an intermediate stage. The reference
de-duplicates after every step; only the last DISTINCT before a count or an
extract changes a result, so the composed pipeline turns the others off and
saves a full shuffle of the birth records each.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.params import (
    CHILD_HEALTH_CODES, CODE_NEONATAL, CODE_STILLBIRTH, FLAG_NEONATAL, FLAG_NEONATAL_ASSUMED,
    FLAG_STILLBIRTH, FLAG_STILLBIRTH_ASSUMED, NEONATAL_MAX_DAYS, NEONATAL_MIN_DAYS, TERM_GESTATION,
)


def _maybe_distinct(df: DataFrame, dedupe: bool) -> DataFrame:
    return df.distinct() if dedupe else df


def clean_births(raw: DataFrame, start_date: _dt.date | None = None,
                 excluded_codes=CHILD_HEALTH_CODES) -> DataFrame:
    """J1 + B5/B6: parse the birth date, derive the trust, apply the start date and
    drop excluded codes. ``NOT IN`` semantics: a NULL site code is dropped too."""
    df = (raw.withColumn("date_of_birth", F.try_to_date(F.col("Dob"), "yyyyMMdd"))
          .withColumn("Trust_Code", F.substring(F.col("Actual_delivery_Ods_Code"), 1, 3)))
    if start_date is not None:
        df = df.filter(F.col("date_of_birth") >= F.lit(start_date))
    keep = ~F.col("Actual_delivery_Ods_Code").isin(*excluded_codes)
    return df.filter(F.col("Actual_delivery_Ods_Code").isNotNull() & keep)


def outcome_class(births: DataFrame) -> DataFrame:
    """Reclassify the deceased-type flag; first matching rule wins."""
    flag = F.col("Deceased_Type_Flag")
    days = F.col("Num_Days_From_Dob_To_Dod")
    new_flag = (F.when(F.col("Dod").isNull(), F.lit(None).cast("string"))
                .when(days.between(NEONATAL_MIN_DAYS, NEONATAL_MAX_DAYS) & (flag == FLAG_STILLBIRTH),
                      F.lit(FLAG_NEONATAL))
                .when(flag == FLAG_NEONATAL_ASSUMED, F.lit(FLAG_NEONATAL))
                .when(flag == FLAG_STILLBIRTH_ASSUMED, F.lit(FLAG_STILLBIRTH))
                .otherwise(flag))
    return births.select("Der_Pseudo_Nhs_Number", "date_of_birth", "Gestation_Age",
                         "Actual_delivery_Ods_Code", "Postcode_Of_Birth", "Trust_Code",
                         new_flag.alias("Deceased_Type_Flag"))


def single_site_trusts(provider: DataFrame) -> DataFrame:
    """J3 + D4/D5: trusts with exactly one (non-null) site, and that site."""
    return (provider.groupBy("Trust_Code")
            .agg(F.count("Site_Code").alias("Num_Sites"), F.max("Site_Code").alias("Site_Code"))
            .filter(F.col("Num_Sites") == 1)
            .select("Trust_Code", "Site_Code"))


def map_single_site(births: DataFrame, single: DataFrame) -> DataFrame:
    """Any code of a single-site trust becomes that site; term births only;
    missing postcode -> 'Missing'; period = month end."""
    b = births.filter(F.col("Gestation_Age") == TERM_GESTATION).alias("a")
    s = single.select(F.col("Trust_Code").alias("st_trust"), F.col("Site_Code").alias("st_site"))
    j = b.join(s, F.col("a.Trust_Code") == F.col("st_trust"), "left")
    return j.select(
        F.col("Der_Pseudo_Nhs_Number").alias("Baby_ID"),
        F.last_day("date_of_birth").alias("Period"),
        "date_of_birth", "Deceased_Type_Flag", "Gestation_Age",
        F.coalesce(F.col("st_site"), F.col("Actual_delivery_Ods_Code")).alias("Site_Code_Mapped_Single_Trusts"),
        F.coalesce(F.col("Postcode_Of_Birth"), F.lit("Missing")).alias("Postcode"))


def apply_mergers(births: DataFrame, mergers: DataFrame, dedupe: bool = True) -> DataFrame:
    """One hop of old -> new site code."""
    m = mergers.select(F.col("Old_Code").alias("m_old"), F.col("New_Code").alias("m_new"))
    j = births.join(m, births.Site_Code_Mapped_Single_Trusts == m.m_old, "left")
    out = j.select("Baby_ID", "Period", "date_of_birth", "Deceased_Type_Flag", "Gestation_Age", "Postcode",
                   F.coalesce(F.col("m_new"), F.col("Site_Code_Mapped_Single_Trusts")).alias("Site_Code_Merged"))
    return _maybe_distinct(out, dedupe)


def apply_postcode_map(births: DataFrame, pmap: DataFrame, dedupe: bool = True) -> DataFrame:
    """Correct the site by (site, postcode)."""
    p = pmap.select(F.col("Site_Code_Old").alias("p_old"), F.col("PostCode").alias("p_pc"),
                    F.col("Site_Code_New").alias("p_new"), "Map_using_postcode", "Justification")
    cond = (births.Site_Code_Merged == p.p_old) & (births.Postcode == p.p_pc)
    j = births.join(p, cond, "left")
    out = j.select("Baby_ID", "date_of_birth", "Period", "Deceased_Type_Flag", "Gestation_Age", "Postcode",
                   "Map_using_postcode", "Justification",
                   F.coalesce(F.col("p_new"), F.col("Site_Code_Merged")).alias("Site_Code"))
    return _maybe_distinct(out, dedupe)


def with_trust(births: DataFrame, provider: DataFrame) -> DataFrame:
    """Current-site flag; trust from the provider list, else the code's first 3 characters."""
    p = provider.select(F.col("Site_Code").alias("ps_site"), F.col("Trust_Code").alias("ps_trust"),
                        F.col("Trust_Name").alias("ps_trust_name"))
    j = births.join(p, births.Site_Code == p.ps_site, "left")
    return j.select(*[F.col(c) for c in births.columns],
                    F.when(F.col("ps_trust_name").isNotNull(), 1).otherwise(0).alias("Current_Site"),
                    F.coalesce(F.col("ps_trust"), F.substring(F.col("Site_Code"), 1, 3)).alias("ods_code"))


def current_only(births: DataFrame, dedupe: bool = True) -> DataFrame:
    """Births at current sites."""
    out = (births.filter(F.col("Current_Site") == 1)
           .select("Baby_ID", "date_of_birth", "Period", "Deceased_Type_Flag", "Site_Code", "ods_code"))
    return _maybe_distinct(out, dedupe)


def events_extract(current: DataFrame, provider: DataFrame) -> DataFrame:
    """One row per baby with an outcome; any flag other than the two known gives a NULL code."""
    p = provider.select(F.col("Site_Code").alias("ps_site"), "Site_Name", "Trust_Name")
    j = (current.filter(F.col("Deceased_Type_Flag").isNotNull())
         .join(p, current.Site_Code == p.ps_site, "left"))
    flag = F.col("Deceased_Type_Flag")
    outcome = (F.when(flag == FLAG_STILLBIRTH, F.lit(CODE_STILLBIRTH))
               .when(flag == FLAG_NEONATAL, F.lit(CODE_NEONATAL)))
    return j.select(
        "ods_code", "Site_Code", "Site_Name", "Trust_Name",
        F.col("date_of_birth").alias("test_date"),
        F.date_format("Period", "yyyy-MM").alias("year_month"),
        F.lit(1).alias("event_count"),
        outcome.alias("outcome"),
        "Baby_ID").distinct()
