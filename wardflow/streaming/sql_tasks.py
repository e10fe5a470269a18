"""Extract tasks that are SQL text: bound parameters, a preparing script, and an output date.

The query is one statement with named markers (``:watermark``); values are bound, never pasted, and tables come as
``IDENTIFIER(:source)``.  A task may have a script that runs before (``BEGIN ... END`` with the same markers): it can set the session variable
``output_date``, which is the task's new watermark, as the output parameter of a procedure would be.  The script's own result is not
used, so no rows pass the driver; the query stays a plan.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

OUTPUT_DATE = "output_date"
_MARKER = re.compile(r"'(?:[^'\\]|\\.|'')*'|--[^\n]*|/\*.*?\*/|`(?:[^`]|``)*`|(?<!:):([A-Za-z_]\w*)", re.S)


def markers(text: str) -> set[str]:
    """Names of the parameter markers of a statement, those in literals, names and comments left out."""
    return {m.group(1) for m in _MARKER.finditer(text) if m.group(1)}


def bound(text: str, params: dict) -> dict:
    """The parameters that a statement asks for; one that is missing is an error."""
    wanted = markers(text)
    missing = sorted(wanted - set(params))
    if missing:
        raise KeyError(f"no value for {', '.join(missing)}")
    return {k: params[k] for k in wanted}


def run_sql(spark: SparkSession, code: str, params: dict, prepare: str | None = None) -> tuple[DataFrame, dt.datetime | None]:
    """(rows, output date) of a SQL task."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {OUTPUT_DATE} TIMESTAMP_NTZ DEFAULT NULL")
    if prepare:
        spark.sql(prepare, args=bound(prepare, params))
    mark = spark.sql(f"SELECT session.{OUTPUT_DATE} AS d").first().d
    return spark.sql(code, args=bound(code, {**params, OUTPUT_DATE: mark})), mark


def parameter_rows(spark: SparkSession, code: str, params: dict) -> DataFrame:
    """Rows of a parameter query; its columns bind by name (see ``sinks.delimited.name_by_parameter``)."""
    return spark.sql(code, args=bound(code, params))
