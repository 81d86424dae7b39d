"""Production runners: outputs written, gates raise after the reports are written."""

import datetime as dt
import os
import tempfile

import pytest

from dummy_data import frames


def test_run_signals_writes_outputs(spark):
    from signalwatch.params import SignalParams
    from signalwatch.plans.pipeline import run_signals
    from signalwatch.plans.signal_plan import SignalFlow
    from signalwatch.sources.readers import read_register
    events, denoms, rates, provider = frames(spark)
    out = tempfile.mkdtemp(prefix="signalwatch-run-", dir="/tmp")
    flow = SignalFlow(events, denoms, rates, provider, SignalParams(run_date=dt.date(2025, 7, 1)))
    summary = run_signals(flow, out)
    assert summary.Number_new_signals == 9
    assert spark.read.parquet(os.path.join(out, "final_parquet")).count() == 549
    assert spark.read.option("header", True).csv(os.path.join(out, "final_csv")).count() == 549
    assert read_register(spark, os.path.join(out, "register"), dt.date(2025, 7, 8)).count() == 9


def test_run_source_raises_after_writing(spark):
    from test_cleaning import _flow
    from signalwatch.plans.pipeline import run_source
    out = tempfile.mkdtemp(prefix="signalwatch-run-", dir="/tmp")
    with pytest.raises(ValueError, match="current trust"):
        run_source(_flow(spark, fast=True, start=dt.date(2025, 1, 1)), out)
    assert spark.read.parquet(os.path.join(out, "events")).count() == 6
    assert os.path.isdir(os.path.join(out, "new_sites_count"))
