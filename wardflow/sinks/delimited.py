"""Delimited, fixed-width and per-parameter outputs, and table outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import report_name


def parse_file_flags(flags: str | None) -> tuple[bool, bool]:
    """(header, quote everything) of a ``NO_HEADER|ADD_QUOTE`` setting."""
    text = (flags or "").upper()
    return "NO_HEADER" not in text, "ADD_QUOTE" in text


def line(columns: list[str], sep: str = ",", quote_all: bool = False) -> Column:
    """A row as one delimited line: NULL is empty, quotes are doubled, and a field is quoted when it
    holds the delimiter, a quote or a line break (or always)."""
    def field(c):
        v = F.coalesce(F.col(c).cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        if quote_all:
            return quoted
        needs = F.contains(v, F.lit(sep)) | F.contains(v, F.lit('"')) | F.contains(v, F.lit("\n")) | F.contains(v, F.lit("\r"))
        return F.when(needs, quoted).otherwise(v)
    return F.concat_ws(sep, *[field(c) for c in columns])


def header_line(columns: list[str], sep: str = ",", quote_all: bool = False) -> str:
    def field(name):
        quoted = '"' + name.replace('"', '""') + '"'
        return quoted if quote_all or any(x in name for x in (sep, '"', "\n", "\r")) else name
    return sep.join(field(c) for c in columns)


def write_delimited(df: DataFrame, path: str, sep: str = ",", flags: str | None = None,
                    encoding: str = "UTF-8", mode: str = "overwrite") -> int:
    """Write delimited files, a header in each, and return the number of rows.

    UTF-8 lines are written as rendered, so line breaks inside a field stay as they are, and no rows give
    a file with the header only.  Other code pages go through the CSV writer: characters the page lacks
    become ``?`` and a line break inside a field takes the form of the line end.
    """
    header, quote_all = parse_file_flags(flags)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if encoding.upper() in ("UTF-8", "UTF8"):
        text = line(df.columns, sep, quote_all)
        first = header_line(df.columns, sep, quote_all)
        if header:
            # The lower bits of this id count the rows of a partition, that is of a file.
            opens = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
            text = F.when(opens, F.concat(F.lit(first + "\r\n"), text)).otherwise(text)
        write_lines(counted, text, path, mode=mode)
        if header and seen.get["rows"] == 0:
            write_lines(df.sparkSession.range(1), F.lit(first), path, mode="append")
    else:
        (counted.write.mode(mode).option("sep", sep).option("header", header).option("quoteAll", quote_all)
         .option("escape", '"').option("nullValue", "").option("emptyValue", '""' if quote_all else "")
         .option("lineSep", "\r\n").option("encoding", encoding)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return seen.get["rows"]


def write_counted(df: DataFrame, write, step: str) -> int:
    """Run ``write(df)`` and return the number of rows that passed, counted in the same job."""
    seen = Observation(step)
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def reconcile(source_rows: int, written_rows: int, step: str) -> int:
    if source_rows != written_rows:
        raise ValueError(f"{step}: read {source_rows} rows, wrote {written_rows}")
    return written_rows


def name_by_parameter(df: DataFrame, params: DataFrame, on: list[str], template: str, at) -> DataFrame:
    """Join rows to the parameter table and give each its output name.

    Parameter columns named like ``file_name_part`` / ``date_part`` fill the name; the others bind by ``on``.
    """
    return df.join(params, on).withColumn("file_name", _parameter_name(params, template, at))


def _parameter_name(params: DataFrame, template: str, at) -> Column:
    def like(word):
        return next((c for c in params.columns if word in c.lower()), None)
    return report_name(template, at, like("file_name_part"), like("date_part"))


def named_parameters(params: DataFrame, template: str, at) -> DataFrame:
    """Output name of every parameter row, with or without rows of its own."""
    return params.select(_parameter_name(params, template, at).alias("file_name"))


def write_by_name(df: DataFrame, path: str, sep: str = ",", flags: str | None = None, names: DataFrame | None = None) -> int:
    """One folder per ``file_name`` in a single job, lines rendered as everywhere else.

    Rows are range-partitioned by name, so a name with many rows is several files; in the order of their names they
    make one output whose first line is the header.  ``names`` lists outputs that must exist without rows too.
    Returns the number of rows written, without headers.
    """
    header, quote_all = parse_file_flags(flags)
    columns = [c for c in df.columns if c != "file_name"]
    lines = df.select("file_name", F.lit(1).alias("_at"), line(columns, sep, quote_all).alias("value"))
    if header:
        listed = df.select("file_name").distinct() if names is None else names.select("file_name").distinct()
        lines = lines.unionByName(listed.select("file_name", F.lit(0).alias("_at"), F.lit(header_line(columns, sep, quote_all)).alias("value")))
    spread = F.xxhash64("value")
    seen = Observation()
    # Counted behind the exchange: what stands before it is read a second time to find the ranges.
    (lines.withColumn("_spread", F.when(F.col("_at") == 0, F.lit(-(1 << 63)).cast("long")).otherwise(spread))
        .repartitionByRange("file_name", "_at", "_spread").sortWithinPartitions("file_name", "_at")
        .observe(seen, F.count(F.when(F.col("_at") == 1, 1)).alias("rows")).drop("_at", "_spread")
        .write.mode("overwrite").partitionBy("file_name").option("lineSep", "\r\n").text(path))
    return seen.get["rows"]


def fixed_width(columns: dict[str, int], ragged_right: bool = False) -> Column:
    """One line of blank-padded, cut fields; ``ragged_right`` leaves the last field unpadded."""
    names = list(columns)
    cells = []
    for c in names:
        v = F.coalesce(F.col(c).cast("string"), F.lit(""))
        last = ragged_right and c == names[-1]
        cells.append(F.substring(v, 1, columns[c]) if last else F.rpad(v, columns[c], " "))
    return F.concat(*cells)


def write_lines(df: DataFrame, text: Column, path: str, line_sep: str = "\r\n", mode: str = "overwrite") -> None:
    df.select(text.alias("value")).write.mode(mode).option("lineSep", line_sep).text(path)


def write_table(df: DataFrame, table: str, truncate: bool) -> None:
    """Replace or append to a table."""
    df.write.mode("overwrite" if truncate else "append").saveAsTable(table)
