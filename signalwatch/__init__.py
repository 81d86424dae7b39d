"""signalwatch: outcome-signal surveillance as Spark DataFrame jobs.

Layout
------
sources/    readers of the reference-shaped inputs, the test-table adapters, sinks
functions/  column-level helpers (dates, rounding, labels, text lists)
operators/  DataFrame -> DataFrame operators (cleaning, quality gates, grid,
            thresholds, CUSUM, line set, VLAD, register, working days)
plans/      composition of the operators into the two pipelines and the
            registered query set
streaming/  incremental refresh driver (availableNow trigger + foreachBatch)
"""

__version__ = "0.1.0"
