"""Outcome code -> tooltip label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalwatch.params import UNKNOWN_LABEL


def outcome_label(code: Column, labels: dict) -> Column:
    """CASE chain over a handful of codes; NULL or any other code gives 'Unknown'."""
    expr = None
    for k, v in labels.items():
        expr = F.when(code == F.lit(k), F.lit(v)) if expr is None else expr.when(code == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(UNKNOWN_LABEL))
