"""Adapters from the driver's star-schema tables to the reference's inputs.

The reference reads birth records, a provider-site list, a merger table and a
postcode map. The test tables carry none of these, so each is expressed on
them (every value below is derived from the given tables, so the work grows
with them):

* site      = one supplier; code ``N<nation:2><suppkey:6>``, so the first three
              characters are the trust (the nation), as in the real codes. Suppliers
              whose key ends in 19, 29 or 49 deliver under a code that the rules leave
              out (an ignored code, a code with the ignored prefix, an excluded code);
              those ending in 39, 59, 69 or 79 deliver at one site of a trust that is
              not current
* provider  = suppliers whose key does not end in 9 (the rest are "new sites"); the row
              of supplier 7 is listed twice
* birth     = one line item; date of birth = ship date; baby id = order-line
              (not unique, so distinct counts matter)
* term      = line status 'O' or even order key
* postcode  = a brand-like code from the part key, missing for every 50th part
* death     = return flag other than 'N'; days to death = quantity mod 35
* flag      = by discount: 10% stillbirth, 9% neonatal, 8% / 0% the "assumed" forms
* mergers   = supplier ending in 3 merged into its predecessor (supplier 3 listed twice)
* postcode map = supplier ending in 4: in an even ten, brand 'Brand#2x' -> its predecessor
              (an existing site; one entry of supplier 4 twice); in an odd ten, every
              brand -> the supplier ending in 12 of its hundred, still to be reviewed
* denominators of the signal half = the births one year later, so that the year before
              the first event year has some; supplier 7 has none and supplier 8 none
              in its last year (what the signal gates count)
* rates     = for each event year and the three years of its period those that have
              births; both sides in the denominators' years
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.params import (
    CHILD_HEALTH_CODES, FLAG_NEONATAL, FLAG_NEONATAL_ASSUMED, FLAG_STILLBIRTH, FLAG_STILLBIRTH_ASSUMED,
    NEW_SITE_IGNORE_CODES, NEW_SITE_IGNORE_PREFIX, POSTCODE_SAME_SITE, TERM_GESTATION,
)

RUN_DATE = _dt.date(2001, 12, 31)
NON_TERM = "Gestation_under37"
NEW_SITE_JUSTIFICATION = "Postcode of a possible new site"
TESTBED_SOURCE = "Derived from test tables"
# The site of suppliers outside every current trust.
LONE_SITE = "Z99001"
# The supplier without denominators, and the one without those of its last year.
NO_DENOMS_KEY, SHORT_DENOMS_KEY = 7, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _zero_pad(c, width: int):
    """Decimal text of a non-negative key, zero-padded to at least ``width`` digits
    (printf's %0Nd; plain ``lpad`` would cut longer keys)."""
    txt = c.cast("string")
    return F.when(c < 10 ** width, F.lpad(txt, width, "0")).otherwise(txt)


def site_code(nationkey, suppkey):
    return F.concat(F.lit("N"), _zero_pad(nationkey, 2), _zero_pad(suppkey, 6))


def delivery_code(nationkey, suppkey):
    """The code a birth is recorded under: the site code, but for the suppliers outside the provider list with a role."""
    end = suppkey % 100
    return (F.when(end == 19, F.lit(NEW_SITE_IGNORE_CODES[0]))
            .when(end == 29, F.concat(F.lit(NEW_SITE_IGNORE_PREFIX), _zero_pad(suppkey, 6)))
            .when(end == 49, F.lit(CHILD_HEALTH_CODES[0]))
            .when(end.isin(39, 59, 69, 79), F.lit(LONE_SITE))
            .otherwise(site_code(nationkey, suppkey)))


def _listed_twice(key, first: int):
    """Explode to two rows for one key, to one for all others."""
    return F.explode(F.when(key == first, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))


def trust_code(nationkey):
    return F.concat(F.lit("N"), _zero_pad(nationkey, 2))


def provider_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (s.filter(F.col("s_suppkey") % 10 != 9)
            .join(n, s.s_nationkey == n.n_nationkey, "left")
            .withColumn("listed", _listed_twice(F.col("s_suppkey"), NO_DENOMS_KEY))
            .select(site_code(F.col("s_nationkey"), F.col("s_suppkey")).alias("Site_Code"),
                    F.col("s_name").alias("Site_Name"),
                    trust_code(F.col("s_nationkey")).alias("Trust_Code"),
                    F.col("n_name").alias("Trust_Name")))


def births_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey, "left")
    ship = F.col("l_shipdate").cast("date")
    dead = F.col("l_returnflag") != F.lit("N")
    pct = F.rint(F.col("l_discount") * 100).cast("int")
    flag = (F.when(pct == 10, F.lit(FLAG_STILLBIRTH))
            .when(pct == 9, F.lit(FLAG_NEONATAL))
            .when(pct == 8, F.lit(FLAG_NEONATAL_ASSUMED))
            .when(pct == 0, F.lit(FLAG_STILLBIRTH_ASSUMED)))
    postcode = F.concat(F.lit("Brand#"), (F.col("l_partkey") % 5 + 1).cast("string"),
                        (F.expr("(l_partkey div 5) % 5") + 1).cast("string"))
    # yyyyMMdd text of the ship date (four-digit years)
    dob = (F.year(ship) * 10000 + F.month(ship) * 100 + F.dayofmonth(ship)).cast("string")
    return j.select(
        dob.alias("Dob"),
        F.when(F.col("s_nationkey").isNotNull(),
               delivery_code(F.col("s_nationkey"), F.col("l_suppkey"))).alias("Actual_delivery_Ods_Code"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("Der_Pseudo_Nhs_Number"),
        F.when((F.col("l_linestatus") == "O") | (F.col("l_orderkey") % 2 == 0), F.lit(TERM_GESTATION))
         .otherwise(F.lit(NON_TERM)).alias("Gestation_Age"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(postcode).alias("Postcode_Of_Birth"),
        F.when(dead, ship).alias("Dod"),
        F.when(dead, F.col("l_quantity").cast("int") % 35).alias("Num_Days_From_Dob_To_Dod"),
        flag.alias("Deceased_Type_Flag"),
    )


def _supplier_pairs(spark: SparkSession, sf_dir: str, last_digit: int, partner) -> DataFrame:
    """Suppliers ending in ``last_digit`` (c) with the supplier whose key is ``partner`` of theirs (p)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cur = s.filter(F.col("s_suppkey") % 10 == last_digit).withColumn("partner", partner(F.col("s_suppkey"))).alias("c")
    return cur.join(s.alias("p"), F.col("p.s_suppkey") == F.col("c.partner"), "inner")


def site_mergers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _supplier_pairs(spark, sf_dir, 3, lambda k: k - 1)
    return pairs.withColumn("listed", _listed_twice(F.col("c.s_suppkey"), 3)).select(
        site_code(F.col("c.s_nationkey"), F.col("c.s_suppkey")).alias("Old_Code"),
        site_code(F.col("p.s_nationkey"), F.col("p.s_suppkey")).alias("New_Code"))


def postcode_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.expr("(s_suppkey div 10) % 2") == 0
    pairs = _supplier_pairs(spark, sf_dir, 4, lambda k: F.when(known, k - 1).otherwise(k - k % 100 + 12))
    same = F.expr("(c.s_suppkey div 10) % 2") == 0
    few = F.array(*[F.lit(f"Brand#2{i}") for i in range(1, 6)])
    every = F.array(*[F.lit(f"Brand#{i}{j}") for i in range(1, 6) for j in range(1, 6)])
    twice = F.concat(few, F.array(F.lit("Brand#21")))
    codes = F.when(F.col("c.s_suppkey") == 4, twice).when(same, few).otherwise(every)
    return pairs.select(
        site_code(F.col("c.s_nationkey"), F.col("c.s_suppkey")).alias("Site_Code_Old"),
        F.explode(codes).alias("PostCode"),
        site_code(F.col("p.s_nationkey"), F.col("p.s_suppkey")).alias("Site_Code_New"),
        F.lit(1).alias("Map_using_postcode"),
        F.when(same, F.lit(POSTCODE_SAME_SITE)).otherwise(F.lit(NEW_SITE_JUSTIFICATION)).alias("Justification"))


def signal_denominators(denoms: DataFrame) -> DataFrame:
    """Denominators as the signal half gets them: each month's births stand for the month a year before.

    One supplier has none and one has none in the last year.
    """
    last = denoms.agg(F.max("Year")).scalar()
    key = F.substring("Site_Code", 4, 12).try_cast("long")
    here = (key != NO_DENOMS_KEY) & ((key != SHORT_DENOMS_KEY) | (F.col("Year") != last))
    return denoms.filter(F.coalesce(here, F.lit(True))).withColumns({
        "Period": F.last_day(F.add_months("Period", -12)), "Year": F.col("Year") - 1})


def with_unkeyed(events: DataFrame) -> DataFrame:
    """The events and, for those of a month's 29th, a second row that has lost its month (the gates count these)."""
    lost = events.filter(F.dayofmonth("test_date") == 29).withColumn("year_month", F.lit(None).cast("string"))
    return events.unionByName(lost)


def with_blank_keys(events: DataFrame, denoms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events and denominators, and second rows of theirs with a blank key: the events of a month's 29th without a
    month and of its 28th without a site, June's denominators without a site and July's without a year."""
    day, month = F.dayofmonth("test_date"), F.month("Period")
    blank = F.lit(None).cast("string")
    events = (events.unionByName(events.filter(day == 29).withColumn("year_month", blank))
              .unionByName(events.filter(day == 28).withColumn("Site_Code", blank)))
    denoms = (denoms.unionByName(denoms.filter(month == 6).withColumn("Site_Code", blank))
              .unionByName(denoms.filter(month == 7).withColumn("Year", F.lit(None).cast("int"))))
    return events, denoms


def first_extract(events: DataFrame) -> DataFrame:
    """What an earlier run got of the events: none of the last two months, and the sites of every fifth supplier had not
    sent the events of a month's third day yet."""
    newest = events.agg(F.max("year_month")).scalar()
    cut = F.date_format(F.add_months(F.to_date(F.concat(newest, F.lit("-01"))), -1), "yyyy-MM")
    late = (F.substring("Site_Code", 4, 12).try_cast("long") % 5 == 2) & (F.dayofmonth("test_date") == 3)
    return events.filter((F.col("year_month") < cut) & ~F.coalesce(late, F.lit(False)))


def reference_rates(events: DataFrame, denoms: DataFrame) -> DataFrame:
    """National rate for each event year Y, labelled 'Y-3 - Y-1': events / term births of those of its years that have births.

    ``denoms`` are those of the signal half; the events of a year belong to the
    denominators a year before. Yearly totals first (one row per year), then
    each year is counted towards the three event years it belongs to.
    """
    ev = (events.groupBy((F.year("test_date") - 1).alias("y"))
          .agg(F.sum("event_count").cast("long").alias("ev")))
    bi = (denoms.groupBy(F.col("Year").alias("y"))
          .agg(F.sum("Term_Births").cast("long").alias("bi")))
    yearly = bi.join(ev, "y", "left").fillna(0, ["ev"])
    contrib = yearly.select("ev", "bi", F.explode(F.sequence(F.col("y") + 1, F.col("y") + 3)).alias("Y"))
    per = contrib.groupBy("Y").agg(F.sum("ev").alias("Events"), F.sum("bi").alias("Denom"))
    return per.select(
        F.concat((F.col("Y") - 3).cast("string"), F.lit("-"), (F.col("Y") - 1).cast("string")).alias("Year"),
        F.col("Events").cast("long").alias("Events"),
        F.col("Denom").cast("long").alias("Denom"),
        (F.col("Events") / F.col("Denom")).alias("Ref_Rate"),
        F.lit(TESTBED_SOURCE).alias("Source"))


def given_thresholds(control: DataFrame) -> DataFrame:
    """A threshold table for each in-control count, as a caller may hand one in: k = 1.5 ic, intervals 1 + ic and 2 + 2 ic."""
    ic = F.col("inControlCount")
    return (control.select(ic).filter(ic > 0).distinct()
            .select(ic.alias("ic"), (F.rint(ic * 150) / 100).alias("k"), (1 + ic).alias("h_L1"), (2 + 2 * ic).alias("h_L2")))


def previous_register(register: DataFrame, run_date: _dt.date) -> DataFrame:
    """A plausible last-run register derived from this run's signals, all notified 14 days ago.

    By the site's key modulo 3: 0 - its level-1 signals are new now, its level-2
    ones stood at a site that has vanished; 1 - its level-1 signals stood at level 2
    (lowered now); 2 - its level-2 signals stood at level 1 (raised now).
    """
    key = F.substring(F.col("Site_Code"), 4, 12).try_cast("long") % 3
    lvl = F.substring_index(F.col("ID"), "-", -1)
    base = F.substring_index(F.col("ID"), "-", 2)
    gone = key == 0
    new_id = (F.when((key == 1) & (lvl == "1"), F.concat(base, F.lit("-2")))
              .when((key == 2) & (lvl == "2"), F.concat(base, F.lit("-1")))
              .when(gone, F.concat(F.lit("X"), F.col("ID"))).otherwise(F.col("ID")))
    return (register.filter(~(gone & (lvl == "1")))
            .select(new_id.alias("ID"), F.when(gone, F.concat(F.lit("X"), F.col("Site_Code"))).otherwise(F.col("Site_Code")).alias("Site_Code"),
                    "Site_Name", "ODS_Code", "ODS_Name", F.date_sub(F.lit(run_date), 14).alias("Date_Email")))
