"""The reference's dummy inputs, embedded (30 events, 3 sites x 12 months, one national rate)."""

import datetime as dt

# --- fixed values: dummy events (site, day/month/year, outcome) -------------
EVENTS = [
    ("ABC01", "16/05/2025", "NND"), ("ABC01", "14/05/2025", "SB"), ("ABC02", "28/04/2025", "NND"),
    ("ABC02", "07/06/2025", "SB"), ("ABC03", "25/04/2025", "NND"), ("ABC03", "27/06/2025", "SB"),
    ("ABC01", "04/04/2025", "NND"), ("ABC01", "21/01/2025", "SB"), ("ABC02", "24/01/2025", "NND"),
    ("ABC02", "22/05/2025", "SB"), ("ABC03", "16/02/2025", "NND"), ("ABC03", "15/01/2025", "SB"),
    ("ABC01", "17/05/2025", "NND"), ("ABC01", "28/04/2025", "SB"), ("ABC02", "21/06/2025", "NND"),
    ("ABC02", "18/06/2025", "SB"), ("ABC03", "24/03/2025", "NND"), ("ABC03", "15/04/2025", "SB"),
    ("ABC01", "19/02/2025", "NND"), ("ABC01", "03/01/2025", "SB"), ("ABC02", "13/02/2025", "NND"),
    ("ABC02", "06/03/2025", "SB"), ("ABC03", "24/02/2025", "NND"), ("ABC03", "18/01/2025", "SB"),
    ("ABC01", "30/03/2025", "NND"), ("ABC01", "03/04/2025", "SB"), ("ABC02", "13/03/2025", "NND"),
    ("ABC02", "10/03/2025", "SB"), ("ABC03", "12/06/2025", "NND"), ("ABC03", "14/04/2025", "SB"),
]
# Term births per month of 2024, January to December.
TERM_BIRTHS = {
    "ABC01": [219, 196, 209, 212, 224, 202, 200, 206, 207, 217, 204, 204],
    "ABC02": [411, 409, 410, 389, 375, 355, 405, 381, 375, 374, 359, 380],
    "ABC03": [190, 222, 235, 228, 232, 216, 225, 239, 226, 225, 207, 197],
}
RATE = ("2022-2024", 200, 100000, 0.002, "Local Data")
TRUST = ("ABC", "EXAMPLE FOUNDATION TRUST")
# ---------------------------------------------------------------------------


def frames(spark):
    from pyspark.sql import functions as F

    from signalwatch.functions.dates import parse_date_any

    ev_rows = []
    for site, day, outcome in EVENTS:
        d, m, y = day.split("/")
        ev_rows.append((TRUST[0], site, f"Site Name {site[-1]}", TRUST[1], day, f"{y}-{m}", 1, outcome))
    ev_rows += [(None,) * 8] * 15          # the blank lines at the end of the file
    events = spark.createDataFrame(
        ev_rows, "ods_code string, Site_Code string, Site_Name string, Trust_Name string, test_date string, "
                 "year_month string, event_count int, outcome string")
    events = events.dropna(how="all").withColumn("test_date", parse_date_any("test_date"))
    den_rows = []
    for site, births in TERM_BIRTHS.items():
        for m, b in enumerate(births, start=1):
            last = (dt.date(2024, m % 12 + 1, 1) if m < 12 else dt.date(2025, 1, 1)) - dt.timedelta(days=1)
            den_rows.append((site, last, b, b, 2024))
    denoms = spark.createDataFrame(den_rows, "Site_Code string, Period date, Term_Births int, "
                                             "Term_Live_Births int, Year int")
    rates = spark.createDataFrame([RATE], "Year string, Events int, Denom int, Ref_Rate double, Source string")
    provider = spark.createDataFrame([(s, f"Site Name {s[-1]}", TRUST[0], TRUST[1]) for s in TERM_BIRTHS],
                                     "Site_Code string, Site_Name string, Trust_Code string, Trust_Name string")
    return events.withColumn("event_count", F.col("event_count")), denoms, rates, provider
