"""Outputs that are written under their exact names and read back as bytes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import extract, payer_reports, rosters
from ..session import work_path
from ..sinks import codepage, delimited, named, ordered
from ..streaming import sql_tasks
from . import ORACLE, Tables, query
from .basics import RUN_DATE
from .exports import EVENT_COLUMNS, event_rows
from .revenue import _STAYS_SQL, ACTIVE_SINCE, report_drivers, revenue_tables, stays


def published(t: Tables, log: DataFrame, path: str) -> DataFrame:
    """Rows as logged, size and digest of the bytes as they stand in each file."""
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.*").load(f"{path}/*.*")
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha"))
    return files.join(log.select("file_name", F.col("rows").alias("n_rows"), F.col("bytes").alias("logged_bytes")), "file_name", "full")


PARAMETER_SETTING = "_part{index:03}|16KB|NOZIP"
_EVENT_LINE = "concat_ws(',', CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR)) || chr(13) || chr(10)"
_EVENT_HEADER = "'event_id,at,user_id,event_type,value' || chr(13) || chr(10)"


@query("extract_split_by_parameter", f"""
WITH RECURSIVE lines AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE event_type END AS name, event_id, {_EVENT_LINE} AS line FROM events),
placed AS (SELECT name, event_id, line, strlen(line) AS b, CAST(sum(strlen(line)) OVER (PARTITION BY name ORDER BY event_id) AS BIGINT) - strlen(line) AS start FROM lines),
opened AS (
  SELECT DISTINCT name, CAST(0 AS BIGINT) AS open_at FROM lines
  UNION ALL SELECT o.name, n.start FROM opened o, LATERAL (SELECT min(p.start) AS start FROM placed p
     WHERE p.name = o.name AND p.start > o.open_at AND p.start + p.b > o.open_at + 16384 - 38) n WHERE n.start IS NOT NULL),
parts AS (SELECT name, open_at, row_number() OVER w AS part, lead(open_at) OVER w AS close_at FROM opened WINDOW w AS (PARTITION BY name ORDER BY open_at))
SELECT 'EV_' || p.name || '_19980401_part' || lpad(CAST(p.part AS VARCHAR), 3, '0') || '.csv' AS file_name, count(*) AS n_rows,
  CAST(sum(c.b) + 38 AS BIGINT) AS n_bytes, CAST(sum(c.b) + 38 AS BIGINT) AS logged_bytes,
  sha256({_EVENT_HEADER} || string_agg(c.line, '' ORDER BY c.event_id)) AS sha
FROM placed c JOIN parts p ON c.name = p.name AND c.start >= p.open_at AND (p.close_at IS NULL OR c.start < p.close_at) GROUP BY p.name, p.part""")
def extract_split_by_parameter(t: Tables):
    """Every parameter in parts of its own; one parameter holds a third of the rows."""
    rows = event_rows(t).withColumn("file_name_part", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("event_type")))
    lines = extract.file_lines(rows, "EV_<FILENAMEPART>_YYYYMMDD{SPLITINDEX}.csv", F.lit(RUN_DATE), split_setting=PARAMETER_SETTING,
                               order=["event_id"], file_name_part="file_name_part")
    path = work_path(t.spark, "by-parameter")
    log = named.write_named(lines, path, F.col("line"), ["_by0"], codepage.header_bytes(EVENT_COLUMNS))
    return published(t, log, path)


# One byte a character: ASCII and Latin as they are, the euro sign at its place, ? for what the page lacks.
_CP1252 = """unhex(array_to_string(list_transform(string_split({0}, ''), lambda c: CASE WHEN ascii(c) < 128 OR ascii(c) BETWEEN 160 AND 255
  THEN printf('%02X', ascii(c)) WHEN c = '€' THEN '80' ELSE '3F' END), ''))"""
_NOTED = "'\"' || event_type || chr(10) || 'é€字 ' || CAST(user_id AS VARCHAR) || '\"'"


@query("extract_code_page", f"""
WITH lines AS (SELECT event_id, event_type, event_id || '|' || {_NOTED} || chr(13) || chr(10) AS line FROM events)
SELECT 'NOTES_' || event_type || '.txt' AS file_name, count(*) AS n_rows, CAST(sum(length(line)) + 15 AS BIGINT) AS n_bytes,
  CAST(sum(length(line)) + 15 AS BIGINT) AS logged_bytes,
  sha256({_CP1252.format("'event_id|note' || chr(13) || chr(10) || string_agg(line, '' ORDER BY event_id)")}) AS sha
FROM lines GROUP BY event_type""")
def extract_code_page(t: Tables):
    """Notes with line breaks and characters that the code page lacks, as bytes of that page."""
    rows = t.events.select("event_id", F.concat("event_type", F.lit("\né€字 "), F.col("user_id").cast("string")).alias("note"),
                           F.col("event_type").alias("file_name_part"))
    lines = extract.file_lines(rows, "NOTES_<FILENAMEPART>.txt", F.lit(RUN_DATE), "|", encoding="cp1252", order=["event_id"], file_name_part="file_name_part")
    path = work_path(t.spark, "code-page")
    log = named.write_named(lines, path, F.col("line"), ["_by0"], codepage.header_bytes(["event_id", "note"], "|", encoding="cp1252"))
    return published(t, log, path)


def _csv_sql(*fields: str) -> str:
    quoted = [f"CASE WHEN contains({f}, ',') OR contains({f}, '\"') THEN '\"' || replace({f}, '\"', '\"\"') || '\"' ELSE {f} END" for f in fields]
    return " || ',' || ".join(quoted) + " || chr(13) || chr(10)"


_CENSUS_HEADER = "hospital_account,patient_name,dob,subscriber_number,admit_date,primary_dx,admit_provider,patient_class,unit,room_name"
_CENSUS_LINE = _csv_sql(
    "'''' || CAST(o_orderkey AS VARCHAR)", "payer || ', ' || substr(c_name, 1, 8)", "CAST(DATE '1930-01-01' + CAST(o_custkey * 37 % 25000 AS INTEGER) AS VARCHAR)",
    "'SUB' || CAST(o_custkey AS VARCHAR)", "CAST(day AS VARCHAR)", "'DX'", "'DR'", "o_orderstatus", "'U' || CAST(n_nationkey AS VARCHAR)", "'R1'")


@query("census_files", f"""WITH {_STAYS_SQL},
lines AS (SELECT payer, facility, plan, '''' || CAST(o_orderkey AS VARCHAR) AS account, {_CENSUS_LINE} AS line FROM stays WHERE plan <> '5-LOW' AND NOT (plan = '3-MEDIUM' AND n_regionkey = 1)),
driver AS (SELECT DISTINCT payer, facility, plan FROM stays WHERE plan <> '5-LOW'),
texts AS (SELECT d.payer, d.facility, d.plan, count(line) AS n_rows,
  '{_CENSUS_HEADER}' || chr(13) || chr(10) || coalesce(string_agg(line, '' ORDER BY account), '') AS body
  FROM driver d LEFT JOIN lines l ON l.payer = d.payer AND l.facility = d.facility AND l.plan = d.plan GROUP BY ALL)
SELECT 'Census_' || payer || '_' || replace(facility, ' ', '') || '_' || replace(plan, ' ', '') || '_19980401.csv' AS file_name, n_rows,
  CAST(strlen(body) AS BIGINT) AS n_bytes, CAST(strlen(body) AS BIGINT) AS logged_bytes, sha256(body) AS sha FROM texts""")
def census_files(t: Tables):
    """The census of every payer, facility and plan as a file of its own; some have no rows."""
    path = work_path(t.spark, "census")
    log = payer_reports.write_reports(_without_some(t), report_drivers(t, False), payer_reports.CENSUS, "Census_<FILENAMEPART>_YYYYMMDD.csv", F.lit(RUN_DATE), path)
    return published(t, log, path)


def _without_some(t: Tables) -> DataFrame:
    """Stays less one plan in one region, so that its reports are empty."""
    region = t.nation.select(F.col("n_nationkey").alias("location_id"), "n_regionkey")
    return stays(t).join(region, "location_id").where("NOT (plan = '3-MEDIUM' AND n_regionkey = 1)").drop("n_regionkey")


@query("daily_roster_file", """WITH """ + ORACLE["daily_roster"].strip().removeprefix("WITH").rsplit("SELECT 1 AS record_order", 1)[0] + """
, r AS (SELECT 1 AS record_order""" + ORACLE["daily_roster"].rsplit("SELECT 1 AS record_order", 1)[1] + """)
SELECT row_number() OVER (ORDER BY record_order, subscriber_id NULLS FIRST, first_name NULLS FIRST, last_name NULLS FIRST, status NULLS FIRST, group_id NULLS FIRST,
    program_enrolled NULLS FIRST) AS line_no,
  concat_ws('|', coalesce(subscriber_id, ''), coalesce(first_name, ''), coalesce(last_name, ''), coalesce(status, ''), coalesce(group_id, ''), coalesce(program_enrolled, '')) AS value FROM r""")
def daily_roster_file(t: Tables):
    """The roster as one ordered output of many files, read back in order: header, details, trailer."""
    rows = rosters.daily_roster(revenue_tables(t), RUN_DATE, ACTIVE_SINCE)
    path = work_path(t.spark, "roster")
    ordered.write_ordered(rows, delimited.line(rosters.ROSTER_COLUMNS, "|"), ["record_order", *rosters.ROSTER_COLUMNS], path)
    return ordered.read_ordered(t.spark, path)


@query("sql_task_extract", """
WITH mark AS (SELECT max(ts) AS d FROM events WHERE ts > TIMESTAMP '2024-01-15' AND event_type = 'click')
SELECT event_id, user_id, event_type, ts, mark.d AS new_watermark, 'x''; DROP VIEW events; --' AS run_by
FROM events, mark WHERE ts > TIMESTAMP '2024-01-15' AND ts <= mark.d""")
def sql_task_extract(t: Tables):
    """A task that is SQL text: values are bound, one of them hostile, and a script sets the output date."""
    t.events.createOrReplaceTempView("task_events")
    params = {"source": "task_events", "watermark": dt.datetime(2024, 1, 15), "kind": "click", "run_by": "x'; DROP VIEW events; --"}
    prepare = """BEGIN
      DECLARE latest TIMESTAMP_NTZ;
      SET latest = (SELECT max(ts) FROM IDENTIFIER(:source) WHERE ts > :watermark AND event_type = :kind);
      SET output_date = coalesce(latest, :watermark);
    END"""
    rows, mark = sql_tasks.run_sql(t.spark, """SELECT event_id, user_id, event_type, ts, :output_date AS new_watermark, :run_by AS run_by
        FROM IDENTIFIER(:source) WHERE ts > :watermark AND ts <= :output_date""", params, prepare)
    return rows
