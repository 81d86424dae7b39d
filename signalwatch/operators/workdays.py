"""Working-day calendar (England) and due dates n working days on.

Holidays come from a rule for the regular bank holidays of England and Wales
plus a table of one-off changes; callers can pass their own holiday table.
The calendar covers the years the caller derives from its data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: one-off bank-holiday changes in England -----------------
# (added days, and regular days that were moved away that year)
ONE_OFF_HOLIDAYS = ("1995-05-08", "1999-12-31", "2002-06-03", "2002-06-04", "2011-04-29", "2012-06-04",
                    "2012-06-05", "2020-05-08", "2022-06-02", "2022-06-03", "2022-09-19", "2023-05-08")
MOVED_AWAY = ("1995-05-01", "2002-05-27", "2012-05-28", "2020-05-04", "2022-05-30")
# ---------------------------------------------------------------------------


def _easter_sunday(y: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian algorithm) as integer arithmetic."""
    a = y % 19
    b = F.floor(y / 100)
    c = y % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def _weekday0(d: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return (F.dayofweek(d) + 5) % 7


def _first_monday(y: Column, month: int) -> Column:
    d = F.make_date(y, F.lit(month), F.lit(1))
    return F.date_add(d, (7 - _weekday0(d)) % 7)


def _last_monday(y: Column, month: int) -> Column:
    d = F.last_day(F.make_date(y, F.lit(month), F.lit(1)))
    return F.date_sub(d, _weekday0(d))


def bank_holidays(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Bank holidays of England for each year in ``years`` (a small DataFrame of years).

    One array expression per year, exploded: no shuffle."""
    y = F.col(year_col).cast("int")
    jan1 = F.make_date(y, F.lit(1), F.lit(1))
    xmas = F.make_date(y, F.lit(12), F.lit(25))
    boxing = F.make_date(y, F.lit(12), F.lit(26))
    wd = _weekday0
    # Substitute days: a holiday on a weekend moves to the next free weekday.
    new_year = F.when(wd(jan1) == 5, F.date_add(jan1, 2)).when(wd(jan1) == 6, F.date_add(jan1, 1)).otherwise(jan1)
    xmas_obs = F.when(wd(xmas) == 5, F.date_add(xmas, 2)).when(wd(xmas) == 6, F.date_add(xmas, 2)).otherwise(xmas)
    boxing_obs = F.when(wd(boxing) >= 5, F.date_add(boxing, 2)).otherwise(boxing)
    easter = _easter_sunday(y)
    regular = F.array(new_year, F.date_sub(easter, 2), F.date_add(easter, 1), _first_monday(y, 5),
                      _last_monday(y, 5), _last_monday(y, 8), xmas_obs, boxing_obs)
    moved = F.array(*[F.lit(d).cast("date") for d in MOVED_AWAY])
    one_off = F.array(*[F.lit(d).cast("date") for d in ONE_OFF_HOLIDAYS])
    days = F.array_distinct(F.concat(F.filter(regular, lambda d: ~F.array_contains(moved, d)),
                                     F.filter(one_off, lambda d: F.year(d) == y)))
    return years.select(F.explode(days).alias("holiday"))


def calendar(bounds: Column, holidays: DataFrame) -> DataFrame:
    """Numbered calendar of the days in ``bounds`` (an array of dates): day, open (a working day) and number, the working
    days up to and with this one. One row per calendar day, so numbering it in one window is bounded by the years."""
    days = holidays.sparkSession.range(1).select(F.explode(bounds).alias("day"))
    closed = holidays.select(F.col("holiday").alias("day"), F.lit(True).alias("_closed")).distinct()
    open_ = (_weekday0(F.col("day")) < 5) & F.col("_closed").isNull()
    days = days.join(closed, "day", "left").select("day", open_.alias("open"))
    return days.withColumn("number", F.count_if("open").over(Window.orderBy("day")))


def add_working_days(df: DataFrame, date_col: str, n: int, holidays: DataFrame, out: str) -> DataFrame:
    """``out`` = the n-th working day strictly after ``date_col`` (NULL stays NULL).

    The distinct start dates look up their number in one numbered calendar, and the
    day of that number + n is the answer: two equi-joins with a table of one row per
    day, however many start dates there are. The calendar ends n + H weekdays after
    the last start, H the number of holidays, so a closure of any length still
    leaves n working days.
    """
    closed = holidays.agg(F.countDistinct("holiday")).scalar()
    span = (F.ceil((F.lit(n) + closed) * 7 / 5) + 7).cast("int")
    starts = df.select(F.col(date_col).alias("_start")).filter(F.col("_start").isNotNull()).distinct()
    ends = starts.agg(F.min("_start").alias("lo"), F.max("_start").alias("hi"))
    days = calendar(ends.select(F.sequence("lo", F.date_add("hi", span))).scalar(), holidays)
    numbered = starts.join(days.select(F.col("day").alias("_start"), (F.col("number") + n).alias("number")), "_start")
    due = numbered.join(days.filter("open").select("number", F.col("day").alias(out)), "number").drop("number")
    return df.join(due, df[date_col] == due["_start"], "left").drop("_start")


def years_between(df: DataFrame, date_col: str, extra_years: int = 1) -> DataFrame:
    """Years from the first to the last year of ``date_col`` plus ``extra_years`` (one scalar subquery)."""
    years = df.agg(F.sequence(F.min(F.year(date_col)), F.max(F.year(date_col)) + extra_years)).scalar()
    return df.sparkSession.range(1).select(F.explode(years).alias("year"))
