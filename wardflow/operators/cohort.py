"""Rows of a cohort, filtered in the scan of a fact table before any exchange.

The cohort's keys become a Bloom filter, built by an aggregation and read as a scalar subquery, so it is a condition on the scan and runs inside
generated code.  Its size follows the number of keys up to ``MAX_BITS``; a cohort that would fill it gets none.  A semi-join
behind it is exact, so the filter only spares rows the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

MAX_BITS, BITS_PER_KEY = 1 << 23, 12


def _places(key: Column, bits: int) -> list[Column]:
    """Two places of a key in the filter."""
    h = F.xxhash64(key)
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def filter_bits(n: int, max_bits: int = MAX_BITS) -> int | None:
    """Bits for ``n`` keys, a power of two; None where they would be too full (more than one key in four bits)."""
    bits = 1024
    while bits < n * BITS_PER_KEY and bits < max_bits:
        bits *= 2
    return bits if n * 4 <= bits else None


class Cohort:
    """Distinct keys of a cohort, written once by the caller."""

    def __init__(self, keys: DataFrame, key: str, max_bits: int = MAX_BITS):
        self.keys, self.key = keys.select(key).where(F.col(key).isNotNull()).distinct(), key
        self.bits = filter_bits(self.keys.count(), max_bits)
        self._words = self._filter() if self.bits else None

    def _filter(self) -> Column:
        words = self.bits // 64
        place = self.keys.select(F.explode(F.array(*_places(F.col(self.key), self.bits))).alias("p"))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
        found = place.select(F.shiftright("p", 6).alias("w"), mask.alias("m"))
        none = self.keys.sparkSession.range(words).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("m"))
        dense = found.unionByName(none).groupBy("w").agg(F.bit_or("m").alias("m"))
        # One row of a fixed number of words, written once however many scans read it.
        row = dense.agg(F.sort_array(F.collect_list(F.struct("w", "m"))).alias("a")).select(F.col("a.m").alias("words"))
        return materialise(self.keys.sparkSession, row, "cohort-filter").scalar()

    def may_hold(self, key: Column) -> Column:
        """True for every key of the cohort, and for few others."""
        if self._words is None:
            return F.lit(True)
        bit = lambda p: F.call_function("getbit", F.get(self._words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
        one, two = (bit(p) for p in _places(key, self.bits))
        return one & two

    def near(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """Every row of the cohort and few others, without an exchange: for rows that an inner join by the same key follows."""
        return df.where(self.may_hold(F.col(key or self.key)))

    def of(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """Rows of ``df`` whose ``key`` is in the cohort."""
        key = key or self.key
        mine = self.keys.select(F.col(self.key).alias("_cohort"))
        return self.near(df, key).join(mine, F.col(key) == F.col("_cohort"), "left_semi")
