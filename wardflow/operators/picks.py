"""Per-key picks and neighbours: latest, earliest, next row, row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every key in ``order`` (state nulls_first/nulls_last in each column).

    ``row_number() = 1`` is planned with a group limit before the exchange, so a hot key
    sends one row per map task instead of all its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per(df: DataFrame, keys: list[str], time: str, tiebreak: list[str], nulls_first: bool = False) -> DataFrame:
    """Latest row per key.  ``nulls_first=True`` lets a NULL time win, as one source dialect sorts it."""
    t = F.col(time).desc_nulls_first() if nulls_first else F.col(time).desc_nulls_last()
    return first_per(df, keys, [t] + [F.col(c).desc_nulls_last() for c in tiebreak])


def earliest_per(df: DataFrame, keys: list[str], time: str, tiebreak: list[str]) -> DataFrame:
    return first_per(df, keys, [F.col(time).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak])


def placed(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` range-partitioned by ``order`` and written once, with the number of its block.

    Blocks follow the measured distribution of the whole order, so a key with any share of the rows is many
    blocks of even size; block numbers never decrease along the order.
    """
    rows = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    return materialise(df.sparkSession, rows.withColumn("_block", F.spark_partition_id()), label)


def next_row(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    """LEAD(value, 1) per key in ascending ``order``; ``values`` maps new column -> source column.

    ``order`` must be a total order within a key.  A window runs inside each (key, block); the last row of a block
    takes the first row of the key's next block, of which there is one for each block.
    """
    by_order = [F.col(c).asc_nulls_first() for c in order]
    payload = F.struct(*[F.col(src).alias(name) for name, src in values.items()])
    rows = placed(df.withColumn("_key", F.struct(*keys)), ["_key", *order], "next-row")
    led = rows.withColumn("_next", F.lead(payload, 1).over(Window.partitionBy("_key", "_block").orderBy(*by_order)))
    heads = first_per(rows, ["_key", "_block"], by_order).select("_key", "_block", payload.alias("_head"))
    after = heads.withColumn("_after", F.lead("_head", 1).over(Window.partitionBy("_key").orderBy("_block"))).drop("_head")
    out = led.join(after, ["_key", "_block"], "left").withColumn("_next", F.coalesce("_next", "_after"))
    return out.select(*df.columns, *[F.col(f"_next.{name}").alias(name) for name in values])


def count_per(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """COUNT(*) OVER (PARTITION BY keys): counts are combined before the exchange, then joined
    back, so no task has to hold a whole hot key as a window would."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    on = None
    for k in keys:
        same = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        on = same if on is None else on & same
    return df.alias("l").join(counts.alias("r"), on, "left").select("l.*", f"r.{name}")
