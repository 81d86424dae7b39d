"""String aggregation helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_join(sort_key: Column, text: Column, sep: str = ", ") -> Column:
    """Aggregate: texts of a group joined by ``sep`` in ``sort_key`` order (ties by text).

    Used on groups already reduced to one row per outcome code, so a group holds
    at most a handful of items.
    """
    items = F.array_sort(F.collect_list(F.struct(sort_key.alias("k"), text.alias("t"))))
    return F.array_join(F.transform(items, lambda x: x["t"]), sep)


def english_list(names: Column) -> Column:
    """Array of names -> 'a', 'a and b', 'a, b and c'; '' for an empty array."""
    n = F.size(names)
    head = F.array_join(F.slice(names, 1, F.greatest(n - 1, F.lit(1))), ", ")
    last = F.try_element_at(names, F.greatest(n, F.lit(1)))
    return (F.when(n == 0, F.lit(""))
             .when(n == 1, F.try_element_at(names, F.lit(1)))
             .otherwise(F.concat(head, F.lit(" and "), last)))
