"""Calendar expressions with the boundary-counting rules of warehouse SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_WINDOW = dt.date(2099, 1, 1)     # "no such window" date
USE_TODAY = dt.date(1900, 1, 1)     # run-date parameter value that means "today"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def run_date_or_today(value: dt.date | None) -> dt.date:
    return dt.date.today() if value is None or value == USE_TODAY else value


def boundary_diff(unit: str, start, end) -> Column:
    """Number of calendar boundaries between two values (not complete units).

    Jan 31 to Feb 1 is one month; Dec 15 to Feb 1 is one year.  Weeks start on Monday.
    """
    a, b = col(start), col(end)
    years = F.year(b) - F.year(a)
    if unit == "year":
        return years
    if unit == "month":
        return years * 12 + F.month(b) - F.month(a)
    if unit == "week":
        return F.floor(F.datediff(F.trunc(b, "week"), F.trunc(a, "week")) / 7).cast("int")
    if unit == "day":
        return F.datediff(F.to_date(b), F.to_date(a))
    if unit == "minute":
        return F.timestamp_diff("MINUTE", F.date_trunc("minute", a), F.date_trunc("minute", b))
    raise ValueError(f"unknown unit {unit!r}")


def month_start(d, months: int = 0, days: int = 0) -> Column:
    """First day of the month ``months`` away, plus ``days``."""
    return F.date_add(F.add_months(F.trunc(col(d), "MM"), months), days)


def age_at(birth, at) -> Column:
    """Completed years; a 29 February birthday falls on 28 February in other years."""
    b, a = F.to_date(col(birth)), F.to_date(col(at))
    years = F.year(a) - F.year(b)
    return years - (F.add_months(b, years * 12) > a).cast("int")


def date_key(d) -> Column:
    return F.date_format(col(d), "yyyyMMdd").cast("int")


def key_to_date(key) -> Column:
    """Date of a yyyymmdd key; sentinel keys (below 1 or malformed) give NULL."""
    return F.try_to_timestamp(col(key).cast("string"), F.lit("yyyyMMdd")).cast("date")


def date_dim(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Date dimension, one row per day."""
    days = spark.range((last - first).days + 1)
    d = F.date_add(F.lit(first), F.col("id").cast("int"))
    return days.select(d.alias("date_value")).select(
        date_key("date_value").alias("date_key"),
        "date_value",
        F.date_format("date_value", "MM/dd/yyyy").alias("display_string"),
        F.dayofmonth("date_value").alias("day_of_month"),
        F.trunc("date_value", "MM").alias("month_start"),
        F.last_day("date_value").alias("month_end"),
    )


def within_last_years(d, run_date: dt.date, years: int) -> Column:
    return col(d) >= F.add_months(F.lit(run_date), -12 * years)


def exactly_days_ago(d, run_date: dt.date, days: int) -> Column:
    """Exactly ``days`` day boundaries ago, as a half-open range so that it reaches the scan."""
    day = run_date - dt.timedelta(days=days)
    lo = F.lit(day).cast("timestamp_ntz")
    hi = F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz")
    return (col(d) >= lo) & (col(d) < hi)


def day_between(ts, first: dt.date, last: dt.date) -> Column:
    """trunc(ts) BETWEEN first AND last, as a half-open range so that it reaches the scan."""
    lo = F.lit(first).cast("timestamp_ntz")
    hi = F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz")
    return (col(ts) >= lo) & (col(ts) < hi)


def month_grid(run_date, before=3, after=1) -> dict[str, Column]:
    """Month begin, mid (15th) and end columns around ``run_date``."""
    run = col(run_date)
    grid = {"before15": (run <= month_start(run, 0, 14)).cast("int")}
    for n in range(-before, after + 1):
        tag = f"m{abs(n)}" if n < 0 else ("p%d" % n if n else "m0")
        grid[f"{tag}_begin"] = month_start(run, n)
        grid[f"{tag}_mid"] = month_start(run, n, 14)
        grid[f"{tag}_end"] = F.last_day(month_start(run, n))
    return grid
