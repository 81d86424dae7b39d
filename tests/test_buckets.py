"""Tables bucketed by site, and tables by name."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalwatch.plans.testbed_plan import forget, shared_flows
from signalwatch.session import RunFolder
from signalwatch.sources.readers import read_table
from signalwatch.sources.sinks import write_table

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_rows_are_not_shuffled(spark):
    """From the chart months on, fold, line set and daily line stay on the buckets: nothing above the days is dealt out again."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flow = shared_flows(spark, SF)["fixed"]
        for df in (flow.cusum, flow.vlad, flow.lines, flow.final, flow.notified_plan()):
            plan = plan_of(df)
            assert "Bucketed: true" in plan
        for df in (flow.vlad, flow.final, flow.notified_plan()):
            plan = plan_of(df).split("Generate inline(transform(sequence(trunc(Date")[0]
            assert not re.search(r"(?<!Broadcast)Exchange hash", plan)
        assert "Exchange hash" not in plan_of(flow.lines) and "Exchange hash" not in plan_of(flow.cusum)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        forget()


def test_bucketed_tables_go_with_their_folder(spark):
    run = RunFolder(spark)
    kept = run.keep(spark.range(100).select((F.col("id") % 7).alias("site"), "id"), "t", {"n": F.count("*")}, by="site")
    assert kept.count() == 100 and run.seen == {"n": 100} and spark.catalog.tableExists(run.tables[0])
    run.remove()
    assert not spark.catalog.tableExists(f"{run.name}_t")


def test_a_table_by_name(spark):
    run = RunFolder(spark)
    write_table(spark.range(5).withColumn("more", F.lit("x")), f"{run.name}_a", f"{run.path}/a")
    got = read_table(spark, f"{run.name}_a", {"id": "string"})
    assert got.schema == T.StructType([T.StructField("id", T.StringType())]) and got.count() == 5
    with pytest.raises(ValueError, match="lacks the columns"):
        read_table(spark, f"{run.name}_a", {"other": "string"})


def test_day_rows_are_neither_sorted_nor_windowed(spark):
    """The excess runs over months: above the generator of the days nothing sorts, windows or joins them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flow = shared_flows(spark, SF)["fixed"]
        for df in (flow.vlad, flow.final, flow.notified_plan()):
            above, found, _ = plan_of(df).partition("Generate inline(transform(sequence(trunc(Date")
            assert found and not re.search(r"\b(Sort|Window|Exchange hash\w*|\w*Join)\b", above)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        forget()


def test_days_of_a_second_run_are_not_dealt_out(spark, monkeypatch):
    """The line of a refresh is made of months dealt out by site; its days and the old rows that are read again stay put."""
    from signalwatch.operators import carry
    from signalwatch.plans.testbed_plan import refreshed
    plans, write = [], carry.write_dated
    monkeypatch.setattr(carry, "write_dated", lambda df, path, day: (plans.append(plan_of(df)) if path.endswith("line") else None, write(df, path, day)))
    for key, value in (("adaptive.enabled", "false"), ("autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        now = plan_of(carry.current(spark, refreshed(spark, SF), "line"))
        assert len(plans) == 2 and "Exchange hash" not in now and "SortMergeJoin" not in now
        for plan in plans:
            above, found, _ = plan.partition("Generate inline(transform(sequence(trunc(Date")
            assert found and not re.search(r"\b(Sort|Window|Exchange hash\w*|\w*Join)\b", above)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        forget()


def test_births_are_not_dealt_out_for_reference_tables(spark):
    """Derived reference tables are written, so the planner sees their sizes: with a limit far under the estimate of their
    derivation, the births pass all of them without an exchange."""
    from signalwatch.operators import clean
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        src = shared_flows(spark, "/root/testdata/sf0.01")["src"]
        plan = plan_of(clean.with_trust(src.postcode_mapped, src.provider))
        assert "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        forget()
