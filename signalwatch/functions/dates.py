"""Date helpers as Spark column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats accepted on load: ISO first, then the day-first form of the dummy files.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")


def parse_date_any(c: Column | str, formats=DATE_FORMATS) -> Column:
    """First format that parses wins; NULL (never an error) when none does."""
    c = F.col(c) if isinstance(c, str) else c
    s = c.cast("string")
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def month_start(year_month: Column | str) -> Column:
    """'yyyy-MM' -> first day of that month."""
    ym = F.col(year_month) if isinstance(year_month, str) else year_month
    return F.try_to_date(F.concat(ym, F.lit("-01")), "yyyy-MM-dd")


def third_last_day(d: Column) -> Column:
    """Third-last day of the month of ``d``: room for a reset row and a threshold row after it."""
    return F.date_sub(F.last_day(d), 2)


def month_label(d: Column) -> Column:
    """'January 2025' style label."""
    return F.date_format(d, "MMMM yyyy")


def month_index(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def months_apart(a: Column, b: Column) -> Column:
    """Whole months between the month starts of two dates, absolute value."""
    return F.abs(month_index(a) - month_index(b))
