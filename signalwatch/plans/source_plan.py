"""Raw birth records -> events, denominators and quality reports (3.1)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from signalwatch.operators import clean, denominators, quality
from signalwatch.params import SourceParams
from signalwatch.session import RunFolder


class SourceFlow:
    """Lazy stages of the cleaning pipeline; each property is one reference view.

    ``fast=True`` (the composed pipeline) skips DISTINCTs whose effect a later
    DISTINCT or distinct count removes anyway, and writes the cleaned births to
    the shared checkpoint folder once, so that the four outputs and the gates
    read them instead of re-running the chain. The gates are counted by the jobs
    that write those tables. The reference tables are written too: the planner then sees how small
    they are, where the estimate of a derived table (the product of a join's sides) would make
    it deal out all births once for each of them.
    """

    def __init__(self, raw: DataFrame, provider: DataFrame, mergers: DataFrame, pmap: DataFrame,
                 params: SourceParams = SourceParams(), fast: bool = False, persist: bool = False):
        self.raw, self._provider, self._mergers, self._pmap = raw, provider, mergers, pmap
        self.p, self.fast, self.persist = params, fast, persist
        self.folder = RunFolder(raw.sparkSession) if persist else None

    def _keep(self, df: DataFrame, name: str, watched=None) -> DataFrame:
        return self.folder.keep(df, name, watched) if self.persist else df

    @cached_property
    def provider(self) -> DataFrame:
        return self._keep(self._provider, "provider")

    @cached_property
    def mergers(self) -> DataFrame:
        return self._keep(self._mergers, "mergers")

    @cached_property
    def pmap(self) -> DataFrame:
        return self._keep(self._pmap, "postcode_map")

    @cached_property
    def births(self) -> DataFrame:          # J1 (PDS_raw)
        return clean.clean_births(self.raw, self.p.start_date, self.p.excluded_codes)

    @cached_property
    def classified(self) -> DataFrame:      # J2 (PDS_raw1)
        return clean.outcome_class(self.births)

    @cached_property
    def single_site(self) -> DataFrame:     # J3
        return clean.single_site_trusts(self.provider)

    @cached_property
    def single_mapped(self) -> DataFrame:   # J4
        return clean.map_single_site(self.classified, self.single_site)

    @cached_property
    def merged(self) -> DataFrame:          # J5
        return clean.apply_mergers(self.single_mapped, self.mergers, dedupe=not self.fast)

    @cached_property
    def postcode_mapped(self) -> DataFrame:  # J6
        return clean.apply_postcode_map(self.merged, self.pmap, dedupe=not self.fast)

    @cached_property
    def with_trust(self) -> DataFrame:      # J7
        df = clean.with_trust(self.postcode_mapped, self.provider)
        return self._keep(df, "births_with_trust", quality.latest_birth())

    @cached_property
    def current(self) -> DataFrame:         # J8
        return clean.current_only(self.with_trust, dedupe=not self.fast)

    @cached_property
    def events(self) -> DataFrame:          # J9
        df = clean.events_extract(self.current, self.provider)
        return self._keep(df, "events")

    @cached_property
    def births_by_month(self) -> DataFrame:  # J10
        df = denominators.births_by_month(self.current)
        return self._keep(df, "births_by_month")  # sites x months, read three times by the densification

    @cached_property
    def all_births(self) -> DataFrame:
        return denominators.live_births(self.births_by_month)

    @cached_property
    def denoms(self) -> DataFrame:          # J11
        return self._keep(denominators.denoms_complete(self.all_births), "denoms")

    @cached_property
    def unmapped(self) -> DataFrame:        # K1
        return quality.unmapped_sites(self.with_trust if self.persist else self.postcode_mapped)

    @cached_property
    def unmapped_totals(self) -> DataFrame:  # K2
        rows = quality.unmapped_rows(self.with_trust if self.persist else self.postcode_mapped)
        return self._keep(quality.unmapped_totals(rows), "unmapped_totals", quality.unmapped_gates(self.p.min_births))

    @cached_property
    def new_sites(self) -> DataFrame:       # K3
        return quality.new_sites_check(self.with_trust, self.provider, self.p.ignore_codes, self.p.ignore_prefix)

    @cached_property
    def new_sites_count(self) -> DataFrame:  # K4
        rows = quality.new_site_rows(self.with_trust, self.provider, self.p.ignore_codes, self.p.ignore_prefix)
        return self._keep(quality.new_sites_count(rows), "new_sites_count", quality.new_site_gates(self.p.min_births))

    @cached_property
    def mapping_gates(self) -> DataFrame:   # N13
        return quality.mapping_gates(self.provider, self.mergers, self.pmap)

    @cached_property
    def gates(self) -> DataFrame:           # K5, K6
        tables = self.with_trust, self.new_sites_count, self.unmapped_totals  # written by now, and counted
        if not self.persist:
            return quality.quality_gates(*tables[1:], self.current, self.p.min_births)
        types = dict.fromkeys([*quality.new_site_gates(), *quality.unmapped_gates()], "long") | {"latest_birth_date": "date"}
        return quality.observed_row(self.raw.sparkSession, self.folder.seen, types)
