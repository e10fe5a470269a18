"""Delimited sources and file discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import tune

# Layout of the survey file.
SURVEY_COLUMNS = ["surveyid", "program_name", "question_id", "answer_txt"]


def survey_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in SURVEY_COLUMNS])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|", header: bool = True,
                   encoding: str = "windows-1252", file_spec: str | None = None) -> DataFrame:
    """Files of a folder (not of its sub-folders), with positional schema and ``"`` as qualifier."""
    reader = (tune(spark).read.schema(schema).option("sep", sep).option("quote", '"').option("escape", '"')
              .option("header", header).option("encoding", encoding).option("enforceSchema", True)
              .option("mode", "FAILFAST"))
    if file_spec:
        reader = reader.option("pathGlobFilter", file_spec)
    return reader.csv(path)


def any_match(spark: SparkSession, folder: str, file_spec: str) -> bool:
    """Does the folder hold a file of that name pattern."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{file_spec}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def stamped(df: DataFrame, load_time=None) -> DataFrame:
    """Add the load time."""
    return df.withColumn("load_dt", F.current_timestamp() if load_time is None else F.lit(load_time))


def to_int_or_fail(df: DataFrame, column: str) -> DataFrame:
    """Convert text to integer; any value that does not convert fails the load."""
    c = F.col(column)
    converted = c.try_cast("int")
    bad = c.isNotNull() & converted.isNull()
    return df.withColumn(column, F.when(bad, F.raise_error(F.concat(F.lit(f"{column} is not an integer: "), c))).otherwise(converted))
