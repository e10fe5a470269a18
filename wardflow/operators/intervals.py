"""Bounded date windows around an index date, and lists of later dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(left: DataFrame, right: DataFrame, *, key: str, left_date: str, right_date: str,
                  lo: int, hi: int, how: str = "inner") -> DataFrame:
    """Rows of ``right`` from ``lo`` to ``hi`` days after the left date, same key.

    Days are put into buckets as wide as the window: a left row looks into two buckets at most, and
    a hot key is spread over its buckets.  Collapse both sides to one row per (key, day) first where
    the result allows it; then a left row meets at most ``hi - lo + 1`` rows.
    """
    width = hi - lo + 1
    epoch = F.lit("1970-01-01").cast("date")

    def day(c):
        return F.datediff(F.to_date(F.col(c)), epoch)

    def bucket(n):
        return F.floor(n / width).cast("long")

    l = left.withColumn("_b", F.explode(F.sequence(bucket(day(left_date) + lo), bucket(day(left_date) + hi))))
    r = right.withColumn("_rb", bucket(day(right_date))).withColumnRenamed(key, "_rk")
    gap = F.datediff(F.to_date(F.col(right_date)), F.to_date(F.col(left_date)))
    on = (F.col(key) == F.col("_rk")) & (F.col("_b") == F.col("_rb")) & gap.between(lo, hi)
    return l.join(r, on, how).drop("_b", "_rb", "_rk")


def later_days(left: DataFrame, right: DataFrame, *, key: str, left_date: str, right_date: str,
               out: str, fmt: str = "yyyy-MM-dd", sep: str = ",", descending: bool = False) -> DataFrame:
    """Ordered text list of the distinct days in ``right`` after the left date, same key.

    A key is reduced to its set of days, which the calendar bounds, before anything is joined, and each left row takes its
    list from that set; no (left, right) pairs are made, and the left rows are sent once, by key.
    """
    days = right.where(F.col(right_date).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.sort_array(F.collect_set(F.to_date(F.col(right_date)))).alias("_days"))
    texts = days.select("_k", F.transform("_days", lambda d: F.struct(d.alias("day"), F.date_format(d, fmt).alias("text"))).alias("_days"))
    after = F.filter("_days", lambda x: x["day"] > F.to_date(F.col(left_date)))
    after = F.reverse(after) if descending else after
    text = F.when(F.size(after) > 0, F.array_join(F.transform(after, lambda x: x["text"]), sep))
    return left.join(texts, F.col(key) == F.col("_k"), "left").withColumn(out, text).drop("_k", "_days")
