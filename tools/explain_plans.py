"""Plan review: physical-plan shape of the main stages, as a markdown table.

Usage: python tools/explain_plans.py [sf_dir]

For each stage it counts shuffles (Exchange), broadcasts, join kinds,
windows, Python stages and subqueries in ``explain("formatted")`` and lists
the scans' pushed filters. A stage whose result is written is explained when it
is written, so the counts show its work and not the read-back. Adaptive execution
is off, so the plans are whole. ``--no-broadcast`` turns broadcast joins off.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from signalwatch.plans.testbed_plan import shared_flows, source_flow  # noqa: E402
from signalwatch.session import RunFolder, build_session  # noqa: E402

COUNT = {
    "shuffles": r"\bExchange \(\d+\)",
    "broadcasts": r"BroadcastExchange \(\d+\)",
    "BHJ": r"BroadcastHashJoin [A-Za-z]* ?[A-Za-z]* \(\d+\)",
    "SMJ": r"SortMergeJoin [A-Za-z]* ?\(\d+\)",
    "windows": r"\bWindow \(\d+\)",
    "python": r"(MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas) \(\d+\)",
    "subqueries": r"Subquery subquery",
    "scans": r"Scan parquet",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(name: str, df) -> str:
    txt = plan_text(df)
    counts = {k: len(re.findall(p, txt)) for k, p in COUNT.items()}
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", txt)))
    cells = " | ".join(str(counts[k]) for k in COUNT)
    return f"| {name} | {cells} | {'; '.join(pushed)[:160] or '-'} |"


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    if "--no-broadcast" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("| stage | " + " | ".join(COUNT) + " | pushed filters |")
    print("|---|" + "---|" * (len(COUNT) + 1))
    plain = RunFolder.keep

    def keep(folder, df, name, watched=None, by=None):
        print(summarize(f"{name} (written)", df.repartition(folder.buckets, by) if by else df), flush=True)
        return plain(folder, df, name, watched, by)

    RunFolder.keep = keep
    print(summarize("cleaning chain with every DISTINCT (J1-J7)", source_flow(spark, sf, fast=False).with_trust))
    fl = shared_flows(spark, sf)
    src, sig = fl["src"], fl["designed"]
    for read in (lambda: src.denoms, lambda: sig.cusum_out, lambda: sig.notified):
        read()  # writes what it needs
    for name, df in (("unmapped sites (K1)", src.unmapped), ("new sites (K3)", src.new_sites), ("quality gates (K5, K6)", src.gates),
                     ("threshold design (L6)", sig.threshold_table), ("daily events (L16)", sig.daily), ("line set (L13-L15)", sig.lines),
                     ("final table (L17-L19)", sig.final), ("register compare (L20-L21)", sig.compare),
                     ("run summary (L26)", sig.summary)):
        print(summarize(name, df))
    spark.stop()


if __name__ == "__main__":
    main()
