"""Sentinel keys and labels, and current-row filters of slowly changing dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import col

# Labels that mean "no value".
SENTINEL_LABELS = ["*Not Applicable", "*Unspecified", "*Unknown", "*Deleted"]


def real_key(c, floor: int = 0) -> Column:
    """Surrogate key of a real row (floor 0) or of a real date (floor 1)."""
    return col(c) > floor


def no_end_key(c) -> Column:
    """End-date key of something still open."""
    return col(c) < 1


def is_sentinel(c) -> Column:
    return col(c).isin(SENTINEL_LABELS)


def current_rows(df: DataFrame, current: str = "is_current", valid: str | None = None,
                 test: str | None = None, status: str | None = None) -> DataFrame:
    """Current version rows, filtered before any join so that an outer join keeps its left rows."""
    keep = F.col(current) == 1
    if valid:
        keep &= F.col(valid) == 1
    if test:
        keep &= F.col(test) == 0
    if status:
        keep &= F.col(status) != "Deceased"
    return df.where(keep)


def active_on(end, day: dt.date) -> Column:
    """Open, or ending on or after ``day``."""
    return (col(end) >= F.lit(day)) | col(end).isNull()
