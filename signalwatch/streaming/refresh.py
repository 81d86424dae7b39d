"""Weekly refresh as a file stream.

Each file dropped into ``events_dir`` is a full events extract (the weekly
refresh replaces the extract). A file-source stream with
``trigger(availableNow=True)`` and one file per micro-batch picks up the drops
not processed yet (progress lives in the stream's checkpoint location), and
``foreachBatch`` runs the signal pipeline on each extract:

* the register of the newest earlier run is read (partition pruning on run_date),
* the final table, the day's signals and the new register are written under
  ``run_date=`` partitions with dynamic overwrite, so a replayed batch
  rewrites exactly its own partitions (idempotent on retry),
* the one-row run summary is written to a summary table.

The run date is the day on which the extract's file was last written, so a replay
on a later day rewrites the same partitions. A second extract of one day replaces
the first one's outputs, as a second run on one day does.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalwatch.functions.dates import parse_date_any
from signalwatch.params import SignalParams
from signalwatch.plans.signal_plan import SignalFlow
from signalwatch.sources import schemas
from signalwatch.sources.readers import read_register
from signalwatch.sources.sinks import write_dated, write_register


def process_extract(extract: DataFrame, denoms: DataFrame, rates: DataFrame, provider: DataFrame,
                    params: SignalParams, out_base: str) -> SignalFlow:
    """One refresh: chart, register compare and outputs for one events extract."""
    spark = extract.sparkSession
    events = extract.dropna(how="all").withColumn("test_date", parse_date_any("test_date"))
    register_base = os.path.join(out_base, "register")
    old = read_register(spark, register_base, params.run_date)
    flow = SignalFlow(events, denoms, rates, provider, params, old_register=old)
    write_dated(flow.notified, os.path.join(out_base, "final"), params.run_date)
    write_dated(flow.register, os.path.join(out_base, "signals"), params.run_date)
    write_register(flow.new_register, register_base, params.run_date)
    write_dated(flow.summary, os.path.join(out_base, "summary"), params.run_date)
    return flow


def start_refresh(spark: SparkSession, events_dir: str, denoms: DataFrame, rates: DataFrame, provider: DataFrame,
                  out_base: str, checkpoint_location: str,
                  params_for: Callable[[_dt.date], SignalParams] | None = None) -> StreamingQuery:
    """Process every extract that arrived since the last run, one micro-batch per file.

    ``params_for(day)`` gives the run's parameters for the day on which the file was
    last written; by default that day is the run date.
    """
    params_for = params_for or (lambda day: SignalParams(run_date=day))
    stream = (spark.readStream.schema(schemas.EVENTS_CSV).option("header", True)
              .option("maxFilesPerTrigger", 1).csv(events_dir)
              .select("*", F.col("_metadata.file_modification_time").alias("written")))

    def batch(df: DataFrame, batch_id: int) -> None:
        day = df.agg(F.max(F.to_date("written"))).first()[0]
        if day is not None:
            process_extract(df.drop("written"), denoms, rates, provider, params_for(day), out_base)

    return (stream.writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())
