"""Output split into parts of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import split_index_text
from .packing import pack

LINE_END = 2        # bytes of the line end


def split_by_size(df: DataFrame, text: Column, order: list[str], limit_bytes: int, header_bytes: int = 0,
                  index_format: str = "{index}", by: str | None = None) -> DataFrame:
    """Add ``part`` (1, 2, ...) and ``part_index`` so that no part, with its header, exceeds ``limit_bytes``
    unless one row alone does.  Rows are taken in ``order``, which must be unique; ``by`` names outputs that are each
    split for themselves.

    Packing is row by row: a part takes rows up to and including the limit, and closes before the first that does not
    fit.  The result does not depend on the number of partitions.
    """
    packed = pack(df, F.octet_length(text) + LINE_END, order, max(limit_bytes - header_bytes, 1), by)
    return packed.withColumn("part_index", split_index_text(index_format, "part"))


def write_parts(split: DataFrame, text: Column, header: str | None, path: str) -> None:
    """Write one file per part, its header line with the first row of the part."""
    value = text
    if header is not None:
        opens = F.lag("part").over(Window.partitionBy("part").orderBy("line_offset")).isNull()
        value = F.when(opens, F.concat(F.lit(header + "\r\n"), text)).otherwise(text)
    lines = split.select("part", "line_offset", value.alias("value"))
    (lines.repartition("part").sortWithinPartitions("part", "line_offset").drop("line_offset")
        .write.mode("overwrite").partitionBy("part").option("lineSep", "\r\n").text(path))
