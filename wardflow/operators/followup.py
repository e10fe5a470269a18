"""Follow-up buckets: the latest result per case, component and calendar distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import boundary_diff
from .picks import first_per

# Bucket names in order of precedence.
BUCKETS = ["w1", "m1", "m3", "m6", "y1", "ygt1"]


def bucket_of(index, at):
    """First matching boundary difference; other distances give NULL."""
    weeks, months, years = (boundary_diff(u, index, at) for u in ("week", "month", "year"))
    return (
        F.when(weeks == 1, "w1").when(months == 1, "m1").when(months == 3, "m3").when(months == 6, "m6")
        .when(years == 1, "y1").when(years >= 1, "ygt1")
    )


def followup_buckets(cases: DataFrame, results: DataFrame, *, key: str, index_time: str, component: str,
                     time: str, values: list[str], tiebreak: list[str], carry: list[str] | None = None) -> DataFrame:
    """Latest result per (key, index time, component, bucket), long form.

    Week, month and year numbers decide the bucket, so results are first reduced to the latest row per
    (key, component, month, week): at most some 70 rows a year whatever the key holds.  A case then meets the
    rows of two years, and for the open-ended bucket the single last row of the key.  Every bucket lies in one
    year (a week in the year of its Monday, its other days are put there too), so the latest is found where (key, year) meet.

    ``carry`` names columns of the cases: the result then has a row for each case, with these, and needs no join to the cases.
    """
    seen = results.where(F.col(time).isNotNull() & F.col(key).isNotNull()).withColumn(
        "_cell", F.greatest(F.trunc(time, "MM"), F.trunc(time, "week")))  # names month and week
    fields = list(dict.fromkeys([*tiebreak, *values]))
    row = F.struct(F.col(time).alias("time"), *[F.col(c) for c in fields])
    # Ranks are limited per group before the exchange and need no buffer of whole rows.
    newest = [F.col(f"_row.{c}").desc_nulls_last() for c in ("time", *fields)]
    # Both readers ask for the same rows and columns, so that the cells are exchanged once.
    cells = first_per(seen.select(key, component, "_cell", row.alias("_row")), [key, component, "_cell"], newest).where("_cell IS NOT NULL")
    last = first_per(cells.select(key, component, "_row"), [key, component], newest)

    index = cases.where(F.col(index_time).isNotNull() & F.col(key).isNotNull())
    who = [key, index_time, *(carry or [])]
    # Cases that are alike are matched once.
    index = index.groupBy(*who).agg(F.count(F.lit(1)).cast("int").alias("_n")) if carry else index.select(*who).distinct().withColumn("_n", F.lit(1))
    # Numbers of week, month and year are worked out for each row before the join, not for each pair after it.
    def numbers(at, prefix):
        return [F.datediff(F.trunc(at, "week"), F.lit("1970-01-01").cast("date")).alias(f"{prefix}w"), (F.year(at) * 12 + F.month(at)).alias(f"{prefix}m"),
                F.year(at).alias(f"{prefix}y")]

    cell = cells.select(key, component, "_row", *numbers("_cell", "_c"), F.year(F.trunc("_cell", "week")).alias("_cmonday"))
    years = F.when(F.col("_cy") == F.col("_cmonday"), F.array("_cy")).otherwise(F.array("_cy", "_cmonday"))
    # They are not sent along.
    asked = index.select("*", F.explode(F.array(F.year(index_time), F.year(index_time) + 1)).alias("_y")).repartition(key, "_y")
    asked = asked.select("*", *numbers(index_time, "_i"))
    # A merge join leaves its rows where the pick needs them, so they are not exchanged again.
    near = asked.hint("merge").join(cell.withColumn("_y", F.explode(years)), [key, "_y"])
    weeks, months = F.col("_cw") - F.col("_iw"), F.col("_cm") - F.col("_im")
    in_year = F.when(months == 1, "m1").when(months == 3, "m3").when(months == 6, "m6").when(F.col("_cy") - F.col("_iy") == 1, "y1")
    bucket = F.when(weeks == 7, F.when(F.col("_y") == F.col("_cmonday"), "w1")).when(F.col("_y") == F.col("_cy"), in_year)
    near = near.withColumn("bucket", bucket).where("bucket IS NOT NULL")
    far = index.join(last, key).where(F.year("_row.time") - F.year(index_time) >= 2).withColumn("bucket", F.lit("ygt1"))
    keep = [*who, "_n", component, "bucket", "_row"]
    picked = first_per(near.select("_y", *keep), [key, "_y", *keep[1:-1]], newest)
    out = picked.select(*keep).unionByName(far.select(*keep))
    if carry:
        out = out.withColumn("_n", F.explode(F.array_repeat(F.lit(1), F.col("_n"))))
    return out.select(*who, component, "bucket", "_row.time", *[f"_row.{v}" for v in values])
