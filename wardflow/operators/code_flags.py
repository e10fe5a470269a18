"""Condition flags from code patterns.

Patterns are a table (flag, kind, pattern).  A code is matched once, in the code dimension, by an
equi-join on its prefixes; the result is one 64-bit mask per code.  Facts then need a single BIT_OR per
key, which combines before the exchange, whatever the number of flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_FLAGS = 63


def pattern_table(spark: SparkSession, flags: list[str], patterns: list[tuple[str, str, str]]) -> DataFrame:
    """(pattern, exact, size, mask); kind is 'prefix' or 'exact'.  One row per distinct pattern."""
    if len(flags) > MAX_FLAGS:
        raise ValueError(f"at most {MAX_FLAGS} flags fit one mask")
    if any("'" in text or "\\" in text for _, _, text in patterns):
        raise ValueError("patterns must not hold quotes or backslashes")
    bit = {f: 1 << i for i, f in enumerate(flags)}
    masks: dict[tuple[str, bool], int] = {}
    for flag, kind, text in patterns:
        at = (text, kind == "exact")
        masks[at] = masks.get(at, 0) | bit[flag]
    # An inline table of a few hundred rows: a local relation, read without a job.
    rows = ", ".join(f"('{text}', {str(exact).lower()}, {len(text)}, {mask}L)" for (text, exact), mask in sorted(masks.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(pattern, exact, size, mask)")


def code_masks(codes: DataFrame, code: str, patterns: DataFrame, sizes: list[int],
               text_rules: list[tuple[int, Column]] = ()) -> DataFrame:
    """Add ``mask`` to a code dimension.  ``sizes`` are the pattern lengths in use; ``text_rules``
    (bit, condition) cover what a prefix cannot say."""
    distinct = codes.select(F.col(code).alias("_c")).where("_c is not null").distinct()
    cut = F.filter(F.array(*[F.lit(n) for n in sizes]), lambda n: n <= F.length("_c"))
    prefixes = distinct.select("_c", F.explode(F.transform(cut, lambda n: F.substring(F.col("_c"), F.lit(1), n))).alias("_p"))
    # The pattern table is a fixed list of a few hundred rows.
    hit = prefixes.join(F.broadcast(patterns), F.col("_p") == F.col("pattern")).where(
        ~F.col("exact") | (F.length("_c") == F.col("size")))
    masks = hit.groupBy("_c").agg(F.bit_or("mask").alias("mask"))
    out = codes.join(masks, codes[code] == masks["_c"], "left").drop("_c")
    mask = F.coalesce("mask", F.lit(0).cast("long"))
    for bit, rule in text_rules:
        mask = mask.bitwiseOR(F.when(rule, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return out.withColumn("mask", mask)


def masks_per(df: DataFrame, keys: list[str], mask: str = "mask") -> DataFrame:
    """OR of the masks of a key."""
    return df.groupBy(*keys).agg(F.bit_or(mask).alias("mask"))


def flag_columns(flags: list[str], mask: str = "mask") -> list[Column]:
    """0/1 columns out of a mask; a missing mask means 0 everywhere."""
    m = F.coalesce(F.col(mask), F.lit(0).cast("long"))
    return [F.getbit(m, F.lit(i)).cast("int").alias(f) for i, f in enumerate(flags)]
