"""Explicit schemas of the reference-shaped inputs (no inference on load)."""

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, StringType, StructField, StructType,
)


def _s(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


# Signal pipeline inputs. Date columns are read as text and parsed by
# functions.dates.parse_date_any, because the files mix formats.
EVENTS_CSV = _s(("ods_code", StringType()), ("Site_Code", StringType()), ("Site_Name", StringType()),
                ("Trust_Name", StringType()), ("test_date", StringType()), ("year_month", StringType()),
                ("event_count", IntegerType()), ("outcome", StringType()))
DENOMS_CSV = _s(("Site_Code", StringType()), ("Period", StringType()), ("Term_Births", IntegerType()),
                ("Term_Live_Births", IntegerType()), ("Year", IntegerType()))
REF_RATE_CSV = _s(("Year", StringType()), ("Events", IntegerType()), ("Denom", IntegerType()),
                  ("Ref_Rate", DoubleType()), ("Source", StringType()))
# A rate file may give each site its own rate.
REF_RATE_OPTIONAL = _s(("Site_Code", StringType()))
PROVIDER_SITE_CSV = _s(("Site_Code", StringType()), ("Site_Name", StringType()),
                       ("Trust_Code", StringType()), ("Trust_Name", StringType()))

# Source pipeline inputs.
BIRTHS = _s(("Dob", StringType()), ("Actual_delivery_Ods_Code", StringType()),
            ("Der_Pseudo_Nhs_Number", StringType()), ("Gestation_Age", StringType()),
            ("Postcode_Of_Birth", StringType()), ("Dod", DateType()),
            ("Num_Days_From_Dob_To_Dod", IntegerType()), ("Deceased_Type_Flag", StringType()))
SITE_MERGERS = _s(("Old_Code", StringType()), ("New_Code", StringType()))
POSTCODE_MAPPING = _s(("Site_Code_Old", StringType()), ("PostCode", StringType()),
                      ("Site_Code_New", StringType()), ("Map_using_postcode", IntegerType()),
                      ("Justification", StringType()))
