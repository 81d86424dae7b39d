"""The two pipelines wired onto the driver's test tables (see sources.testbed)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import SparkSession

from signalwatch.operators import carry
from signalwatch.params import SignalParams, SourceParams
from signalwatch.plans.signal_plan import SignalFlow
from signalwatch.plans.source_plan import SourceFlow
from signalwatch.session import RunFolder
from signalwatch.sources import testbed as tb

# Oracle-checked queries use literal decision intervals so that the CUSUM and
# everything after it can be compared by value against SQL.
FIXED_H = (2.0, 4.0)


def source_flow(spark: SparkSession, sf_dir: str, fast: bool = False, persist: bool = False) -> SourceFlow:
    return SourceFlow(tb.births_raw(spark, sf_dir), tb.provider_sites(spark, sf_dir),
                      tb.site_mergers(spark, sf_dir), tb.postcode_mapping(spark, sf_dir),
                      SourceParams(), fast=fast, persist=persist)


def signal_flow(spark: SparkSession, sf_dir: str, fixed=FIXED_H, fast: bool = True,
                persist: bool = True, src: SourceFlow | None = None) -> SignalFlow:
    src = src or source_flow(spark, sf_dir, fast=fast, persist=persist)
    return signal_from_source(src, fixed, persist)


def signal_from_source(src: SourceFlow, fixed, persist: bool, measure: str = "All", given: bool = False,
                       unkeyed: bool = False) -> SignalFlow:
    denoms = tb.signal_denominators(src.denoms)
    rates = tb.reference_rates(src.events, denoms)
    params = SignalParams(run_date=tb.RUN_DATE, fixed_thresholds=fixed, selected_measure=measure)
    flow = SignalFlow(tb.with_unkeyed(src.events) if unkeyed else src.events, denoms, rates, src.provider, params,
                      old_register=lambda flow: tb.previous_register(flow.register, tb.RUN_DATE), persist=persist)
    if given:
        flow.use_thresholds(tb.given_thresholds(flow.control))
    return flow


_CACHE: dict = {}
_REFRESHED: dict = {}


def shared_flows(spark: SparkSession, sf_dir: str):
    """Persisted flows per session and data folder, shared by the registered queries.

    The cleaned births, events, denominators, chart months and final table are
    written once to the checkpoint folder; every query then starts from those
    tables instead of re-running the cleaning chain.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        src = source_flow(spark, sf_dir, fast=True, persist=True)
        _CACHE[key] = {"src": src, "fixed": signal_from_source(src, FIXED_H, True),
                       "designed": signal_from_source(src, None, True),
                       "given": signal_from_source(src, None, True, given=True)}
    return _CACHE[key]


def refreshed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of two incremental runs: one on the first extract, a week later one on the whole events."""
    flows, key = shared_flows(spark, sf_dir), (spark.sparkContext.applicationId, sf_dir)
    if key not in _REFRESHED:
        full, src = flows["fixed"], flows["src"]
        params = SignalParams(run_date=tb.RUN_DATE - dt.timedelta(days=7), fixed_thresholds=FIXED_H)
        first = SignalFlow(tb.first_extract(full.events_in), full.denoms_in, full.rates, src.provider, params)
        folder = RunFolder(spark)
        for flow in (first, full):
            carry.refresh(flow.with_thresholds, flow.daily, folder.path, flow.p.run_date)
        first.folder.remove()
        _REFRESHED[key] = folder
    return _REFRESHED[key].path


def forget() -> None:
    """Drop the shared flows and their written tables."""
    for flows in _CACHE.values():
        for flow in flows.values():
            flow.folder.remove()
    for folder in _REFRESHED.values():
        folder.remove()
    _CACHE.clear()
    _REFRESHED.clear()


def signals_from_outputs(spark: SparkSession, sf_dir: str, source_out: str) -> SignalFlow:
    """The production signal flow on the tables that a source run has written."""
    events = spark.read.parquet(os.path.join(source_out, "events"))
    denoms = tb.signal_denominators(spark.read.parquet(os.path.join(source_out, "denoms")))
    return SignalFlow(events, denoms, tb.reference_rates(events, denoms), tb.provider_sites(spark, sf_dir),
                      SignalParams(run_date=tb.RUN_DATE))
