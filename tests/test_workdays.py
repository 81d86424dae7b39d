"""Bank holidays of England and due dates n working days on."""

import datetime as dt

from signalwatch.plans.oracle import HOLIDAYS_1991_2002


def test_holidays_1991_2002(spark):
    from signalwatch.operators.workdays import bank_holidays
    years = spark.range(1991, 2003).withColumnRenamed("id", "year")
    got = sorted(r.holiday.isoformat() for r in bank_holidays(years).collect())
    assert got == sorted(HOLIDAYS_1991_2002)


def test_recent_years(spark):
    from signalwatch.operators.workdays import bank_holidays
    years = spark.range(2022, 2026).withColumnRenamed("id", "year")
    got = {r.holiday for r in bank_holidays(years).collect()}
    for d in ("2022-06-02", "2022-06-03", "2022-09-19", "2022-12-26", "2022-12-27", "2023-05-08",
              "2024-03-29", "2025-04-21", "2025-08-25"):
        assert dt.date.fromisoformat(d) in got
    assert dt.date(2022, 5, 30) not in got


def test_due_dates(spark):
    from signalwatch.operators.workdays import add_working_days, bank_holidays
    years = spark.range(2025, 2027).withColumnRenamed("id", "year")
    df = spark.createDataFrame([(dt.date(2025, 7, 1),), (dt.date(2025, 7, 5),), (None,)], "d date")
    got = {r.d: r.due for r in add_working_days(df, "d", 8, bank_holidays(years), "due").collect()}
    assert got[dt.date(2025, 7, 1)] == dt.date(2025, 7, 11)
    assert got[dt.date(2025, 7, 5)] == dt.date(2025, 7, 16)
    assert got[None] is None
