"""Production batch runs of the two halves, with their outputs and gates."""

from __future__ import annotations

import os

from pyspark.sql import Row

from signalwatch.operators.quality import raise_on_failure
from signalwatch.plans.signal_plan import SignalFlow
from signalwatch.plans.source_plan import SourceFlow
from signalwatch.sources.commits import RunLog
from signalwatch.sources.readers import read_register
from signalwatch.sources.sinks import write_csv, write_dated, write_parquet, write_register


def run_source(flow: SourceFlow, out_base: str, raise_gates: bool = True) -> Row:
    """Cleaning run: events, denominators and the two review reports are written,
    then the one-row gate table is read and, if any gate fails, the run raises
    (after the outputs are written, so the reports can be reviewed). The run's
    intermediate tables go at the end."""
    write_parquet(flow.events, os.path.join(out_base, "events"))
    write_parquet(flow.denoms, os.path.join(out_base, "denoms"))
    write_csv(flow.unmapped, os.path.join(out_base, "unmapped_sites"))
    write_csv(flow.new_sites_count, os.path.join(out_base, "new_sites_count"))
    gates = flow.gates.first()
    if flow.folder:
        flow.folder.remove()
    if raise_gates:
        raise_on_failure(gates, flow.p.min_births)
    return gates


def run_signals(flow: SignalFlow, out_base: str) -> Row:
    """Signal run: compares with the newest register before the run date (unless the flow was
    given one), writes the final table (parquet, and CSV from it), the day's signals, the new
    ones, and the register history, and returns the summary row (the notification text)."""
    run_date, spark = flow.p.run_date, flow.events_in.sparkSession
    register = os.path.join(out_base, "register")
    if not flow.has_register:
        flow.use_register(read_register(spark, register, run_date))
    flow.write_final(os.path.join(out_base, "final_parquet"))
    write_csv(flow.notified, os.path.join(out_base, "final_csv"))
    write_dated(flow.register, os.path.join(out_base, "signals"), run_date)
    write_dated(flow.formatted.filter("Email_Trust = 1"), os.path.join(out_base, "new_signals"), run_date)
    write_register(flow.new_register, register, run_date)
    summary = flow.summary.first()
    if flow.folder:
        flow.folder.remove()
    return summary


REGISTER_COLS = ["ID", "Site_Code", "Site_Name", "ODS_Code", "ODS_Name", "Date_Email"]


def run_committed(flow: SignalFlow, out_base: str) -> Row:
    """Signal run whose outputs become visible together (``sources.commits``): final table, signals, new signals,
    register and summary, all parquet. It compares with the register of the newest known run of an earlier date."""
    run_date, log = flow.p.run_date, RunLog(flow.events_in.sparkSession, out_base)
    run = log.start(run_date)
    if not flow.has_register:
        flow.use_register(log.read("register", before=run_date))
    flow.write_final(log.path(run, "final"))
    outputs = {"signals": flow.register, "new_signals": flow.formatted.filter("Email_Trust = 1"),
               "register": flow.new_register.select(*REGISTER_COLS), "summary": flow.summary}
    for name, df in outputs.items():
        write_parquet(df, log.path(run, name))
    log.commit(run, run_date, ["final", *outputs])
    if flow.folder:
        flow.folder.remove()
    return log.read("summary").first()
