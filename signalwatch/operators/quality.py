"""Data-quality reports and gates (K1-K6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.params import GATE_MIN_BIRTHS, NEW_SITE_IGNORE_CODES, NEW_SITE_IGNORE_PREFIX, POSTCODE_SAME_SITE


def unmapped_rows(mapped: DataFrame) -> DataFrame:
    """Births at sites found by postcode whose postcode is no existing site, repeats included."""
    return (mapped.filter((F.col("Map_using_postcode") == 1) & (F.col("Justification") != POSTCODE_SAME_SITE))
            .select("Baby_ID", "Period", "Deceased_Type_Flag", "Gestation_Age", "Postcode", "Site_Code"))


def unmapped_sites(mapped: DataFrame) -> DataFrame:
    """K1: the distinct births of ``unmapped_rows``."""
    return unmapped_rows(mapped).distinct()


def unmapped_totals(unmapped: DataFrame) -> DataFrame:
    """K2: distinct babies per (period, outcome, site); repeated rows do no harm."""
    return (unmapped.groupBy("Period", "Deceased_Type_Flag", "Site_Code")
            .agg(F.countDistinct("Baby_ID").alias("Total")))


def new_sites_check(with_trust: DataFrame, provider: DataFrame, ignore_codes=NEW_SITE_IGNORE_CODES,
                    ignore_prefix: str = NEW_SITE_IGNORE_PREFIX) -> DataFrame:
    """K3: the distinct births of ``new_site_rows``."""
    return new_site_rows(with_trust, provider, ignore_codes, ignore_prefix).distinct()


def new_site_rows(with_trust: DataFrame, provider: DataFrame, ignore_codes=NEW_SITE_IGNORE_CODES,
                  ignore_prefix: str = NEW_SITE_IGNORE_PREFIX) -> DataFrame:
    """Births at codes outside the provider list, with a flag for a current trust, repeats included.

    Joined to the distinct trusts rather than to all sites, so a trust with many
    sites does not multiply the rows (the reference removes that fan-out again
    with a DISTINCT).
    """
    trusts = provider.select(F.col("Trust_Code").alias("ct_trust")).distinct()
    cand = with_trust.filter((F.col("Current_Site") == 0)
                             & ~F.col("Site_Code").isin(*ignore_codes)
                             & (F.substring(F.col("Site_Code"), 1, 1) != F.lit(ignore_prefix)))
    j = cand.join(trusts, cand.ods_code == trusts.ct_trust, "left")
    return j.select("ods_code", "Site_Code", "Postcode", "Gestation_Age", "Deceased_Type_Flag", "Period",
                    "Baby_ID", F.when(F.col("ct_trust").isNotNull(), 1).otherwise(0).alias("Current_Trust"))


def new_sites_count(check: DataFrame) -> DataFrame:
    """K4: distinct babies per (site, period, current-trust flag); repeated rows do no harm."""
    return (check.groupBy("Site_Code", "Period", "Current_Trust")
            .agg(F.countDistinct("Baby_ID").alias("Total")))


def new_site_gates(min_births: int = GATE_MIN_BIRTHS) -> dict[str, Column]:
    """The gates that count rows of ``new_sites_count``."""
    return {"new_site_over_min_births": F.count_if((F.col("Total") > min_births) & (F.col("Current_Trust") == 0)),
            "new_site_in_current_trust": F.count_if(F.col("Current_Trust") == 1)}


def unmapped_gates(min_births: int = GATE_MIN_BIRTHS) -> dict[str, Column]:
    """The gates that count rows of ``unmapped_totals``."""
    return {"unmapped_site_with_event": F.count_if(F.col("Deceased_Type_Flag").isNotNull()),
            "unmapped_site_over_min_births": F.count_if(F.col("Total") > min_births)}


def latest_birth() -> dict[str, Column]:
    """The last birth at a current site, of ``with_trust``."""
    return {"latest_birth_date": F.max(F.when(F.col("Current_Site") == 1, F.col("date_of_birth")))}


def quality_gates(new_counts: DataFrame, unmapped_tot: DataFrame, current: DataFrame,
                  min_births: int = GATE_MIN_BIRTHS) -> DataFrame:
    """K5 + K6 as one row: each gate is a count, any count > 0 fails the run.

    Each figure is a global aggregate evaluated as a scalar subquery (partial
    aggregation on every partition, one tiny final merge); nothing is collected
    by this function. ``raise_on_failure`` acts on the row at the edge. A flow that
    writes its tables watches the same figures while it writes (``observed_row``).
    """
    unmapped = unmapped_gates(min_births)
    ut = unmapped_tot.agg(F.struct(*(c.alias(k) for k, c in unmapped.items()))).scalar()
    latest = current.agg(F.max("date_of_birth")).scalar()
    return new_counts.agg(*(c.alias(k) for k, c in new_site_gates(min_births).items())).select(
        "*", *(ut.getField(k).alias(k) for k in unmapped), latest.alias("latest_birth_date"))


def observed_row(spark: SparkSession, seen: dict, types: dict[str, str]) -> DataFrame:
    """Watched figures as one row; a count of nothing is 0."""
    return spark.range(1).select(*(F.lit(0 if seen[k] is None and t == "long" else seen[k]).cast(t).alias(k) for k, t in types.items()))


GATE_MESSAGES = {
    "new_site_over_min_births": "At least one new site to investigate with more than {n} births in a month",
    "new_site_in_current_trust": "At least one new site at a current trust that needs mapping",
    "unmapped_site_with_event": "Unmapped site to investigate with at least one event",
    "unmapped_site_over_min_births": "Unmapped site to investigate with more than {n} births in a month",
}


def raise_on_failure(gates_row, min_births: int = GATE_MIN_BIRTHS) -> None:
    """Edge-of-pipeline check on the collected one-row gate table."""
    failed = [GATE_MESSAGES[k].format(n=min_births) for k in GATE_MESSAGES if gates_row[k] and gates_row[k] > 0]
    if failed:
        raise ValueError("; ".join(failed))


def mapping_gates(provider: DataFrame, mergers: DataFrame, pmap: DataFrame) -> DataFrame:
    """Keys of the reference tables that occur more than once.

    A duplicated key makes the left joins of the cleaning chain multiply births
    (later distinct counts hide it). One row of counts; any count > 0 is worth
    a look before a run.
    """
    def dup(df: DataFrame, *keys: str):
        return (df.groupBy(*keys).count().filter(F.col("count") > 1)
                .agg(F.count(F.lit(1))).scalar())
    return provider.sparkSession.range(1).select(
        dup(provider, "Site_Code").alias("duplicate_provider_sites"),
        dup(mergers, "Old_Code").alias("duplicate_merger_codes"),
        dup(pmap, "Site_Code_Old", "PostCode").alias("duplicate_postcode_keys"))
