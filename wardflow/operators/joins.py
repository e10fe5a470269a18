"""Join patterns of the warehouse reports.

No side is forced to broadcast: Catalyst and adaptive execution choose that from measured sizes,
and split hot partitions of a shuffled join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def left_join_where(left: DataFrame, right: DataFrame, on: list[str], keep: Column) -> DataFrame:
    """Left join with a predicate on the right side that keeps left rows: filter, then join."""
    return left.join(right.where(keep), on, "left")


def join_first_key(left: DataFrame, right: DataFrame, left_keys: list[str], right_key: str, how: str = "left") -> DataFrame:
    """Join on the first non-NULL of several left keys; stays one equi-join."""
    keyed = left.withColumn("_fk", F.coalesce(*left_keys))
    return keyed.join(right, keyed["_fk"] == right[right_key], how).drop("_fk")


def exists_flag(left: DataFrame, right: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """0/1 columns: does any right row of the key meet the condition.  One pass for all flags.

    Rows that meet none are filtered out first, so the conditions reach the scan.
    """
    any_of = reduce(lambda a, b: a | b, flags.values())
    seen = right.where(any_of).groupBy(F.col(key).alias("_k")).agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(f) for f, c in flags.items()])
    joined = left.join(seen, left[key] == seen["_k"], "left").drop("_k")
    return joined.withColumns({f: F.coalesce(f, F.lit(0)) for f in flags})


def lookups(fact: DataFrame, chain: list[tuple[DataFrame, str, str, dict[str, str]]]) -> DataFrame:
    """Left joins to code lists: (list, fact key, list key, {output: list column})."""
    def one(df, step):
        table, fk, pk, outs = step
        side = table.select(F.col(pk).alias("_pk"), *[F.col(c).alias(o) for o, c in outs.items()])
        return df.join(side, df[fk] == side["_pk"], "left").drop("_pk")
    return reduce(one, chain, fact)


def named_rows(dim: DataFrame, key: str, facts: DataFrame, fact_key: str, label: str) -> DataFrame:
    """Rows of a dimension that the facts name, written once, so that the planner knows their true size.

    A fact table then meets a dimension that outgrew a broadcast without an exchange by a key of few values.
    """
    used = facts.select(F.col(fact_key).alias("_used")).distinct()
    return materialise(dim.sparkSession, dim.join(used, dim[key] == used["_used"], "left_semi"), label)


def anti_append(stage: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Stage rows whose key is not loaded yet, compared column by column.

    Repeats inside the stage are all kept.  A NULL key in the target does not block the load, as a NOT IN would.
    """
    return stage.join(target.select(*keys).distinct(), keys, "left_anti")


def anti_append_legacy(stage: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """The original rule: NOT IN over the keys glued together (1|23 equals 12|3; one NULL blocks all)."""
    def glued(df):
        return F.concat(*[df[k].cast("string") for k in keys])
    known = target.select(glued(target).alias("_g")).distinct()
    blocked = known.where("_g is null").limit(1).select(F.lit(True).alias("_blocked"))
    fresh = stage.withColumn("_g", glued(stage)).where("_g is not null").join(known, "_g", "left_anti")
    return fresh.join(blocked, F.lit(True), "left_anti").drop("_g")


def all_of(parts: list[DataFrame], keys: list[str], base: DataFrame) -> DataFrame:
    """Fold feature frames (each one row per key) onto the base by left joins on the same key,
    so that one partitioning of the base serves every join."""
    return reduce(lambda df, part: df.join(part, keys, "left"), parts, base)
