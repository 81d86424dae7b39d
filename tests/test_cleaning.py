"""Cleaning rules (J1-J11) and quality reports (K1-K6) on hand-made records."""

import datetime as dt

import pytest

PROVIDER = [("T01A", "Site A", "T01", "Trust One"), ("T01B", "Site B", "T01", "Trust One"),
            ("T02A", "Site C", "T02", "Trust Two")]
MERGERS = [("T01C", "T01A")]
PMAP = [("T01B", "PC1", "T01A", 1, "Postcode same as existing site"),
        ("T01B", "PC9", "X99Z", 1, "New site under review")]
D = dt.date(2025, 1, 5)
T = "Gestation_over37"
# (Dob, code, baby, gestation, postcode, Dod, days, flag)
BIRTHS = [
    ("20250105", None, "b01", T, "PC2", None, None, None),                      # null code: dropped
    ("20250105", "R0B1D", "b02", T, "PC2", None, None, None),                   # excluded code
    ("20250105", "T01A", "b03", T, "PC2", D, 1, "Stillbirth"),                  # -> Neonatal
    ("20250105", "T01A", "b04", T, "PC2", D, 28, "Stillbirth"),                 # -> Neonatal
    ("20250105", "T01A", "b05", T, "PC2", D, 0, "Stillbirth"),                  # stays
    ("20250105", "T01A", "b06", T, "PC2", D, 29, "Stillbirth"),                 # stays
    ("20250105", "T01A", "b07", T, "PC2", D, 3, "Neonatal - Assumed"),          # -> Neonatal
    ("20250105", "T01A", "b08", T, "PC2", D, 0, "Stillbirth - Assumed"),        # -> Stillbirth
    ("20250105", "T01A", "b09", T, "PC2", None, None, "Stillbirth"),            # no death date -> NULL
    ("20250105", "T02X", "b10", T, "PC2", None, None, None),                    # single-site trust -> T02A
    ("20250105", "T01C", "b11", T, "PC2", None, None, None),                    # merged -> T01A
    ("20250105", "T01B", "b12", T, "PC1", None, None, None),                    # postcode match -> T01A
    ("20250105", "T01B", "b13", T, "PC2", None, None, None),                    # mismatch stays T01B
    ("20250105", "T01B", "b14", T, None, None, None, None),                     # null postcode -> Missing
    ("20250105", "T01Z", "b15", T, "PC2", None, None, None),                    # new site, current trust
    ("20250105", "Q99Z", "b16", T, "PC2", None, None, None),                    # new site, no trust
    ("20250105", "T01A", "b17", T, "PC2", None, None, None),                    # same baby twice
    ("20250105", "T01A", "b17", T, "PC2", None, None, None),
    ("20250105", "T01A", "b18", "Gestation_under37", "PC2", None, None, None),  # not term
    ("20250105", "T01B", "b19", T, "PC9", D, 0, "Stillbirth"),                  # unmapped site with an event
    ("20241231", "T01A", "b20", T, "PC2", None, None, None),                    # before the start date
]


def _flow(spark, fast, start=None):
    from signalwatch.params import SourceParams
    from signalwatch.plans.source_plan import SourceFlow
    from signalwatch.sources import schemas
    raw = spark.createDataFrame(BIRTHS, schemas.BIRTHS)
    prov = spark.createDataFrame(PROVIDER, schemas.PROVIDER_SITE_CSV)
    merg = spark.createDataFrame(MERGERS, schemas.SITE_MERGERS)
    pmap = spark.createDataFrame(PMAP, schemas.POSTCODE_MAPPING)
    return SourceFlow(raw, prov, merg, pmap, SourceParams(start_date=start), fast=fast, persist=False)


@pytest.fixture(scope="module")
def ref(spark):
    return _flow(spark, fast=False, start=dt.date(2025, 1, 1))


def test_flags_and_filters(ref):
    got = {r.Der_Pseudo_Nhs_Number: r.Deceased_Type_Flag for r in ref.classified.collect()}
    assert "b01" not in got and "b02" not in got and "b20" not in got
    assert [got[b] for b in ("b03", "b04", "b05", "b06", "b07", "b08", "b09")] == [
        "Neonatal", "Neonatal", "Stillbirth", "Stillbirth", "Neonatal", "Stillbirth", None]


def test_site_mapping(ref):
    sites = {r.Baby_ID: (r.Site_Code, r.Postcode) for r in ref.postcode_mapped.collect()}
    assert sites["b10"][0] == "T02A"
    assert sites["b11"][0] == "T01A"
    assert sites["b12"][0] == "T01A" and sites["b13"][0] == "T01B"
    assert sites["b14"] == ("T01B", "Missing")
    assert sites["b19"][0] == "X99Z"
    assert "b18" not in sites
    assert [r.Trust_Code for r in ref.single_site.collect()] == ["T02"]


def test_current_births_and_counts(ref):
    cur = ref.current.collect()
    assert sorted(r.Baby_ID for r in cur if r.Baby_ID == "b17") == ["b17"]
    counts = {r.Site_Code: (r.Term_Births, r.Term_Live_Births) for r in ref.all_births.collect()}
    # T01A: b03-b09, b11, b12, b17 = 10 babies; stillbirths b05, b06, b08
    assert counts["T01A"] == (10, 7)
    assert counts["T01B"] == (2, 2)
    assert counts["T02A"] == (1, 1)
    ev = {r.Baby_ID: r.outcome for r in ref.events.collect()}
    assert ev == {"b03": "NND", "b04": "NND", "b05": "SB", "b06": "SB", "b07": "NND", "b08": "SB"}


def test_quality_reports(ref):
    new = {r.Site_Code: r.Current_Trust for r in ref.new_sites_count.collect()}
    assert new == {"T01Z": 1, "Q99Z": 0, "X99Z": 0}
    un = ref.unmapped_totals.collect()
    assert [(r.Site_Code, r.Deceased_Type_Flag, r.Total) for r in un] == [("X99Z", "Stillbirth", 1)]
    g = ref.gates.first()
    assert (g.new_site_over_min_births, g.new_site_in_current_trust, g.unmapped_site_with_event,
            g.unmapped_site_over_min_births) == (0, 1, 1, 0)
    assert g.latest_birth_date == dt.date(2025, 1, 5)
    from signalwatch.operators.quality import raise_on_failure
    with pytest.raises(ValueError):
        raise_on_failure(g)


def test_denominators_complete(ref):
    rows = ref.denoms.collect()
    assert {r.Site_Code for r in rows} == {"T01A", "T01B", "T02A"}
    assert all(r.Year == 2025 for r in rows)


def test_fast_flow_same_outputs(spark, ref):
    fast = _flow(spark, fast=True, start=dt.date(2025, 1, 1))
    for name in ("events", "all_births", "denoms", "unmapped", "unmapped_totals", "new_sites", "new_sites_count",
                 "gates"):
        a = sorted(map(tuple, getattr(ref, name).collect()), key=str)
        b = sorted(map(tuple, getattr(fast, name).collect()), key=str)
        assert a == b, name
