"""Text expressions with the NULL, blank and case rules of the source dialects."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import col


def concat_tsql(*parts) -> Column:
    """CONCAT that reads NULL as an empty string."""
    return F.concat_ws("", *[col(p).cast("string") for p in parts])


def concat_strict(*parts) -> Column:
    """CONCAT that is NULL when any part is NULL."""
    return F.concat(*[col(p).cast("string") for p in parts])


def like_any(c, patterns, ignore_case: bool = True) -> Column:
    """True when any pattern matches; NULL input gives NULL, as in SQL."""
    value = F.upper(col(c)) if ignore_case else col(c)
    hit = None
    for p in patterns:
        one = value.like(p.upper() if ignore_case else p)
        hit = one if hit is None else hit | one
    return hit


def not_like_all(c, patterns, ignore_case: bool = True) -> Column:
    """AND of NOT LIKE; a NULL input never passes a filter on it."""
    return ~like_any(c, patterns, ignore_case)


def tsql_len(c) -> Column:
    """LEN ignores trailing blanks."""
    return F.length(F.rtrim(col(c)))


def tsql_isnumeric(c) -> Column:
    """ISNUMERIC as 0/1: signs, one point, thousands commas, a currency sign or an exponent pass."""
    t = F.trim(col(c))
    number = r"^[+-]?[$]?[+-]?[$]?([0-9][0-9,]*(\.[0-9]*)?|\.[0-9]+|\.)([eEdD][+-]?[0-9]+)?$"
    sign_only = r"^([+-]|[$]|[+-][$]|[$][+-]|,|\.)$"
    return F.coalesce(t.rlike(number) | t.rlike(sign_only), F.lit(False)).cast("int")


def drop_first(c, n: int) -> Column:
    """RIGHT(x, LEN(x) - n); NULL where the text is shorter than what is to be dropped."""
    size = tsql_len(c)
    return F.when(size >= n, F.substring(col(c), n + 1, 2_000_000_000))


def split_name(c, legacy: bool = False) -> tuple[Column, Column]:
    """(last, first) of ``LAST, FIRST MIDDLE``.

    ``legacy=True`` repeats the report's original cut, which measures the first blank on the
    left-trimmed rest but cuts the untrimmed one, so a blank after the comma costs a letter.
    """
    name = col(c)
    comma = F.instr(name, ",")
    last = F.when(comma > 1, F.substring(name, F.lit(1), comma - 1))
    rest = F.substring(name, comma + 1, F.length(name))
    trimmed = F.ltrim(rest)
    blank = F.instr(trimmed, " ")
    cut_from = rest if legacy else trimmed
    first = (
        F.when(comma == 0, F.lit(None).cast("string"))
        .when(blank > 0, F.ltrim(F.substring(cut_from, F.lit(1), blank - 1)))
        .otherwise(trimmed)
    )
    return last, first


def text_cell(c) -> Column:
    """Leading apostrophe that keeps a spreadsheet from reading an id as a number."""
    return concat_tsql(F.lit("'"), c)


# Date words and format letters accepted in output name templates.
DATE_WORDS = {"YYYYMMDD": "%Y%m%d", "MMDDYYYY": "%m%d%Y"}
FORMAT_LETTERS = {
    "Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss",
    "y": "yy", "b": "MMM", "B": "MMMM", "I": "hh", "p": "a", "j": "DDD",
}


def _date_token(template: str) -> tuple[str, str] | None:
    """(token in the template, strftime pattern) of the last ``_`` segment, if it is a date."""
    if "_" not in template:
        return None
    token = template.rsplit("_", 1)[1].split(".")[0].replace("{SPLITINDEX}", "")
    pattern = DATE_WORDS.get(token.upper(), token)
    return (token, pattern) if "%" in pattern else None


def report_name(template: str, at, file_name_part=None, date_part=None, split_index=None) -> Column:
    """Output name as a column, so names are data and one job can write many files.

    The last ``_`` segment of the template may be a date word or a strftime pattern;
    ``<FILENAMEPART>``, ``<DATEPART>`` and ``{SPLITINDEX}`` are filled from columns.
    """
    token = _date_token(template)
    pieces = [template]
    if token:
        head, tail = template.rsplit(token[0], 1) if token[0] in template else (template, "")
        stamp = re.split(r"%([A-Za-z])", token[1])
        stamped = [
            F.date_format(col(at), FORMAT_LETTERS[s]) if i % 2 else F.lit(s) for i, s in enumerate(stamp)
        ]
        pieces = [head, *stamped, tail]
    name = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])
    for tag, value in (("<FILENAMEPART>", file_name_part), ("<DATEPART>", date_part), ("{SPLITINDEX}", split_index)):
        filled = F.lit("") if value is None else F.coalesce(col(value).cast("string"), F.lit(""))
        name = F.replace(name, F.lit(tag), filled)
    return name


_INDEX = re.compile(r"\{index(?::0(\d+))?\}")


def split_index_text(index_format: str, index) -> Column:
    """``{index}``, ``{index:03}`` or text around them, filled from a column."""
    found = _INDEX.search(index_format)
    if not found:
        return F.lit(index_format)
    number = col(index).cast("string")
    if found.group(1):
        width = int(found.group(1))
        number = F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))
    return F.concat(F.lit(index_format[: found.start()]), number, F.lit(index_format[found.end():]))


# Size units of the split setting.
SIZE_UNITS = {"KB": 1024, "MB": 1024**2, "GB": 1024**3}


def parse_split_setting(setting: str) -> tuple[str, float, str, bool]:
    """``_part{index}|300.5KB|ZIPFILES`` -> (index format, size, unit, zip flag)."""
    found = re.fullmatch(r"([^|]*)\|(?i:(\d+(?:\.\d+)?)(KB|MB|GB))\|(?i:(ZIPFILES|NOZIP))", setting)
    if found is None:
        raise ValueError("expected 'index format|size such as 500MB or 300.5KB|ZIPFILES or NOZIP'")
    index_format, amount, unit, archive = found.groups()
    return index_format, float(amount), unit.upper(), archive.upper() == "ZIPFILES"


def split_limit_bytes(setting: str) -> int:
    _, size, unit, _ = parse_split_setting(setting)
    return int(size * SIZE_UNITS[unit])
