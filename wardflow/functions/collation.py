"""Text columns that compare as the source databases compare them.

A collated column carries its rule: joins, DISTINCT, GROUP BY, IN, =, ORDER BY and LIKE on it ignore case, trailing blanks, or
both, and the value that is kept is one of those that occur, unchanged.  Comparison stays on the JVM and an equi-join stays a
hash or merge join on the collation's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import col


def rule(ignore_case: bool = True, ignore_trailing: bool = True) -> str:
    """Name of the collation."""
    return ("UTF8_LCASE" if ignore_case else "UTF8_BINARY") + ("_RTRIM" if ignore_trailing else "")


def collated(c, ignore_case: bool = True, ignore_trailing: bool = True) -> Column:
    return F.collate(col(c).cast("string"), rule(ignore_case, ignore_trailing))


def plain(c) -> Column:
    """The text itself, compared byte by byte again."""
    return F.collate(col(c), "UTF8_BINARY")


def collate_columns(df: DataFrame, columns: list[str], ignore_case: bool = True, ignore_trailing: bool = True) -> DataFrame:
    """``df`` with the given columns under the rule of their source."""
    return df.withColumns({c: collated(c, ignore_case, ignore_trailing) for c in columns})


def plain_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """For sinks that know no collations."""
    return df.withColumns({c: plain(c) for c in columns})
