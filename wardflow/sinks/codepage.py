"""Lines as the bytes of a code page."""

from __future__ import annotations

import codecs
import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import delimited

# Code pages by their normalised name, and what the JVM calls them.
CODE_PAGES = {"utf-8": "UTF-8", "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1", "iso8859-15": "ISO-8859-15", "cp1250": "windows-1250",
              "cp1251": "windows-1251", "cp1252": "windows-1252", "cp437": "IBM437", "cp850": "IBM850", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE"}


def charset(encoding: str | None) -> str:
    """The JVM's name of an encoding; an unknown one is an error."""
    name = codecs.lookup(encoding or "utf-8").name
    if name not in CODE_PAGES:
        raise ValueError(f"no code page for {encoding!r}")
    return CODE_PAGES[name]


@contextlib.contextmanager
def _replacing(spark: SparkSession):
    """Let ``encode`` take any code page and write ? for what it lacks; fixed in the expression when it is resolved."""
    wanted = {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def with_lines(df: DataFrame, columns: list[str], sep: str = ",", quote_all: bool = False, encoding: str | None = None, name: str = "line") -> DataFrame:
    """Add the row as one delimited line in bytes, line end included; characters that the code page lacks become ``?`` and line breaks
    inside a field stay as they are."""
    text = F.concat(delimited.line(columns, sep, quote_all), F.lit("\r\n"))
    if len(columns) == 1 and not quote_all:  # a lone empty field would read as no row
        text = F.when(F.coalesce(F.col(columns[0]).cast("string"), F.lit("")) == "", F.lit('""\r\n')).otherwise(text)
    with _replacing(df.sparkSession):
        return df.withColumn(name, F.encode(text, charset(encoding)))


def header_bytes(columns: list[str], sep: str = ",", quote_all: bool = False, encoding: str | None = None) -> bytes:
    return (delimited.header_line(columns, sep, quote_all) + "\r\n").encode(codecs.lookup(encoding or "utf-8").name, "replace")


def line_size(line: str = "line") -> Column:
    return F.octet_length(line)
