"""One output in a total order over many files: read in the order of their names, they are the output.

Rows are range-partitioned by their order, so every file holds one stretch of it and files are written side by side; a file is named by its
partition, which follows the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, line: Column, order: list[str], path: str, line_sep: str = "\r\n", files: int | None = None) -> None:
    """Write ``line`` of every row in ``order`` (total), in about ``files`` files, or as many as adaptive execution makes of the data."""
    rows = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], line.alias("value"))
    by = [F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))]
    (rows.repartitionByRange(*([files] if files else []), *by).sortWithinPartitions(*by).select("value")
        .write.mode("overwrite").option("lineSep", line_sep).text(path))


def read_ordered(spark: SparkSession, path: str, line_sep: str = "\r\n") -> DataFrame:
    """(line_no, value) of the output, lines numbered from 1 through all files.

    Lines are numbered inside their file; one row for each file carries the count on.
    """
    lines = (spark.read.option("lineSep", line_sep).text(path)
             .select(F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), "value",
                     F.monotonically_increasing_id().alias("_at")))
    part = Window.partitionBy("_file", "_block").orderBy("_at")
    numbered = lines.withColumn("_no", F.row_number().over(part))
    sizes = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    bases = sizes.select("_file", "_block", (F.sum("_n").over(Window.orderBy("_file", "_block")) - F.col("_n")).alias("_base"))
    return numbered.join(bases, ["_file", "_block"]).select((F.col("_base") + F.col("_no")).alias("line_no"), "value")
