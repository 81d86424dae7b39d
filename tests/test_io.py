"""Readers and sinks."""

import datetime as dt
import os
import tempfile


def _tmp():
    return tempfile.mkdtemp(prefix="signalwatch-test-", dir="/tmp")


def test_csv_reader_drops_blank_rows_and_bom(spark):
    from signalwatch.sources.readers import read_events, read_ref_rate
    d = _tmp()
    p = os.path.join(d, "events.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("ods_code,Site_Code,Site_Name,Trust_Name,test_date,year_month,event_count,outcome\n")
        f.write("ABC,ABC01,Site Name 1,T,16/05/2025,2025-05,1,NND\n")
        f.write("ABC,ABC02,Site Name 2,T,2025-04-28,2025-04,1,SB\n")
        f.write(",,,,,,,\n,,,,,,,\n")
    ev = read_events(spark, p).collect()
    assert len(ev) == 2
    assert {r.test_date for r in ev} == {dt.date(2025, 5, 16), dt.date(2025, 4, 28)}
    q = os.path.join(d, "rate.csv")
    with open(q, "w", encoding="utf-8-sig") as f:
        f.write("Year,Events,Denom,Ref_Rate,Source\n2022-2024,200,100000,0.002,Local Data\n")
    r = read_ref_rate(spark, q).collect()
    assert r[0].Year == "2022-2024" and r[0].Ref_Rate == 0.002


def test_csv_and_parquet_sinks(spark):
    from signalwatch.sources.sinks import write_csv, write_parquet
    d = _tmp()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    write_csv(df, os.path.join(d, "one"), single_file=True)
    parts = [f for f in os.listdir(os.path.join(d, "one")) if f.endswith(".csv")]
    assert len(parts) == 1
    assert open(os.path.join(d, "one", parts[0])).readline().strip() == "x,y"
    write_csv(df.limit(1), os.path.join(d, "one"), single_file=True)    # replaces
    back = spark.read.option("header", True).csv(os.path.join(d, "one")).collect()
    assert len(back) == 1
    write_parquet(df, os.path.join(d, "pq"))
    assert spark.read.parquet(os.path.join(d, "pq")).count() == 2


def test_register_history_round_trip(spark):
    from signalwatch.sources.readers import read_register
    from signalwatch.sources.sinks import write_register
    base = os.path.join(_tmp(), "register")
    assert read_register(spark, base, dt.date(2025, 7, 1)) is None
    reg1 = spark.createDataFrame([("S1-May 2025-1", "S1", "n", "T", "t", dt.date(2025, 6, 1))],
                                 "ID string, Site_Code string, Site_Name string, ODS_Code string, ODS_Name string, "
                                 "Date_Email date")
    write_register(reg1, base, dt.date(2025, 6, 1))
    reg2 = reg1.union(spark.createDataFrame([("S2-June 2025-2", "S2", "m", "T", "t", dt.date(2025, 7, 1))],
                                            reg1.schema))
    write_register(reg2, base, dt.date(2025, 7, 1))
    write_register(reg2, base, dt.date(2025, 7, 1))                    # same-day re-run replaces its own day
    before = read_register(spark, base, dt.date(2025, 7, 1))
    assert [r.ID for r in before.collect()] == ["S1-May 2025-1"]
    later = read_register(spark, base, dt.date(2025, 7, 8))
    assert sorted(r.ID for r in later.collect()) == ["S1-May 2025-1", "S2-June 2025-2"]


def test_register_csv_is_not_funnelled_through_one_task(spark, monkeypatch):
    from signalwatch.plans import queries
    from signalwatch.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    asked, whole = [], queries.write_csv

    def spied(df, path, single_file=False):
        asked.append(single_file)
        whole(df.repartition(3), path, single_file)
    monkeypatch.setattr(queries, "write_csv", spied)
    back = queries.queries()["csv_register"](spark, "/root/testdata/sf0.001")
    assert asked == [False]
    assert back.count() == queries.queries()["register_compare"](spark, "/root/testdata/sf0.001").count() > 0
