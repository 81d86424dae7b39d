"""Gates that are counted by the jobs that write the tables."""

import datetime as dt

import pytest
from dummy_data import frames
from test_cleaning import _flow

from signalwatch.params import SignalParams, SourceParams
from signalwatch.plans.signal_plan import SignalFlow
from signalwatch.plans.source_plan import SourceFlow
from signalwatch.sources.testbed import with_unkeyed


def written_flow(spark, raw=None):
    f = _flow(spark, fast=True)
    return SourceFlow(f.raw if raw is None else raw, f.provider, f.mergers, f.pmap, SourceParams(), fast=True, persist=True)


def test_observed_gates_equal_the_counted_ones(spark):
    written, counted = written_flow(spark), _flow(spark, fast=True)
    row = written.gates.first()
    assert row == counted.gates.first() and set(written.folder.seen) == set(row.asDict())


def test_gates_of_no_births(spark):
    flow = written_flow(spark, _flow(spark, fast=True).raw.filter("false"))
    assert tuple(flow.gates.first()) == (0, 0, 0, 0, None)


@pytest.mark.parametrize("change", ["none", "no rates", "a site without denominators", "no denominators", "no events"])
def test_observed_signal_gates_equal_the_counted_ones(spark, change):
    events, denoms, rates, provider = frames(spark)
    events = with_unkeyed(events)
    if change == "no rates":
        rates = rates.filter("false")
    if change == "a site without denominators":
        denoms = denoms.filter("Site_Code <> 'ABC02'")
    if change == "no denominators":
        denoms = denoms.filter("false")
    if change == "no events":
        events = events.filter("false")
    rows = [SignalFlow(events, denoms, rates, provider, SignalParams(run_date=dt.date(2025, 7, 1), fixed_thresholds=(2.0, 4.0)), persist=p)
            .signal_gates.first() for p in (True, False)]
    assert rows[0] == rows[1] and (rows[0].events_without_denominator > 0) == ("denominators" in change)
