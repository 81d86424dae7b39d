"""Run parameters and fixed values.

Everything a run depends on is passed in explicitly as a frozen object; no
module reads globals at run time.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# --- fixed values that must equal the reference's for the same results ----
# Site codes of child-health records, excluded from the birth extract.
CHILD_HEALTH_CODES = ("R0B1D", "R1F46", "RD1CH", "REFCH", "RTE86")
# Codes that never count as a possible new site (island, forces, support units).
NEW_SITE_IGNORE_CODES = ("DF905", "0CF", "X19", "NW604", "8HK81", "XMDA1", "8JR36")
# Site codes starting with this prefix are out of scope for the new-site check.
NEW_SITE_IGNORE_PREFIX = "7"
# Term-gestation marker in the birth records.
TERM_GESTATION = "Gestation_over37"
# Justification text of a postcode mapping that needs no review.
POSTCODE_SAME_SITE = "Postcode same as existing site"
# Deceased-type flags of the raw records.
FLAG_STILLBIRTH = "Stillbirth"
FLAG_NEONATAL = "Neonatal"
FLAG_NEONATAL_ASSUMED = "Neonatal - Assumed"
FLAG_STILLBIRTH_ASSUMED = "Stillbirth - Assumed"
# Outcome codes of the event table.
CODE_STILLBIRTH = "SB"
CODE_NEONATAL = "NND"
CODE_HIE = "HIE"
# Tooltip labels: monthly chart and daily chart; anything else is "Unknown".
MONTH_LABELS = {"NND": "Neonatal Death(s)", "SB": "Stillbirth(s)", "HIE": "HIE(s)"}
DAY_LABELS = {"NND": "Term Neonatal Death(s)", "SB": "Term Stillbirth(s)", "HIE": "Term HIE(s)"}
UNKNOWN_LABEL = "Unknown"
# Target average run lengths of the two signal levels.
L1_ARL = 20
L2_ARL = 100
# Steps on which the reference value k is tried, in order.
K_STEPS = (0.01, 0.1, 0.2, 0.5)
# Working days between notification and checklist due date.
CHECKLIST_WORKING_DAYS = 8
# Days before the neonatal window: deaths on day 1..28 after a stillbirth flag are neonatal.
NEONATAL_MIN_DAYS = 1
NEONATAL_MAX_DAYS = 28
# Births per month above which a new or unmapped site fails the quality gate.
GATE_MIN_BIRTHS = 10
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SignalParams:
    """Parameters of one signal run."""

    run_date: _dt.date
    # "All" uses all term births as denominator, anything else live births only.
    selected_measure: str = "All"
    l1_arl: int = L1_ARL
    l2_arl: int = L2_ARL
    k_steps: tuple = K_STEPS
    # Fixed thresholds (h_L1, h_L2) instead of the ARL design, or None.
    fixed_thresholds: tuple | None = None
    checklist_working_days: int = CHECKLIST_WORKING_DAYS
    # Chart every month between the first and last event month, not only
    # months with an event somewhere.
    full_month_calendar: bool = False


@dataclass(frozen=True)
class SourceParams:
    """Parameters of the birth-record cleaning run."""

    start_date: _dt.date | None = None
    excluded_codes: tuple = CHILD_HEALTH_CODES
    ignore_codes: tuple = NEW_SITE_IGNORE_CODES
    ignore_prefix: str = NEW_SITE_IGNORE_PREFIX
    min_births: int = GATE_MIN_BIRTHS
