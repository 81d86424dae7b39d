"""Weekly refresh driver: two extracts arrive, each is processed once; the second finds no new signals."""

import datetime as dt
import os
import tempfile

from dummy_data import EVENTS, TRUST, frames


def _write_extract(path):
    with open(path, "w") as f:
        f.write("ods_code,Site_Code,Site_Name,Trust_Name,test_date,year_month,event_count,outcome\n")
        for site, day, outcome in EVENTS:
            d, m, y = day.split("/")
            f.write(f"{TRUST[0]},{site},Site Name {site[-1]},{TRUST[1]},{day},{y}-{m},1,{outcome}\n")
        f.write(",,,,,,,\n" * 3)


def test_refresh_two_weeks(spark):
    from signalwatch.streaming.refresh import start_refresh
    base = tempfile.mkdtemp(prefix="signalwatch-stream-", dir="/tmp")
    drops, out, ck = (os.path.join(base, x) for x in ("drops", "out", "ck"))
    os.makedirs(drops)
    _, denoms, rates, provider = frames(spark)

    def drop(name, day):
        path = os.path.join(drops, name)
        _write_extract(path)
        noon = dt.datetime.combine(day, dt.time(12), dt.timezone.utc).timestamp()
        os.utime(path, (noon, noon))

    drop("week1.csv", dt.date(2025, 7, 1))
    start_refresh(spark, drops, denoms, rates, provider, out, ck).awaitTermination()
    drop("week2.csv", dt.date(2025, 7, 8))
    start_refresh(spark, drops, denoms, rates, provider, out, ck).awaitTermination()

    summary = {r.run_date: r.Number_new_signals for r in spark.read.parquet(os.path.join(out, "summary")).collect()}
    assert summary == {dt.date(2025, 7, 1): 9, dt.date(2025, 7, 8): 0}
    reg = spark.read.parquet(os.path.join(out, "register"))
    assert reg.filter("run_date = DATE'2025-07-08'").count() == 9
    assert reg.filter("run_date = DATE'2025-07-08'").select("Date_Email").distinct().first()[0] == dt.date(2025, 7, 1)

    # a replay of both extracts on a later day (a lost stream checkpoint) rewrites the same partitions
    start_refresh(spark, drops, denoms, rates, provider, out, os.path.join(base, "ck2")).awaitTermination()
    again = {r.run_date: r.Number_new_signals for r in spark.read.parquet(os.path.join(out, "summary")).collect()}
    assert again == summary
