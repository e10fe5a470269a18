"""Outputs, loads, watermarks and audit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import text
from ..sinks import delimited, split
from ..sources import nested
from ..streaming import incremental, survey
from ..session import work_path
from . import Tables, query
from .basics import RUN_DATE

EVENT_COLUMNS = ["event_id", "at", "user_id", "event_type", "value"]


def event_rows(t: Tables):
    return t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "user_id", "event_type", "value")


@query("extract_delimited", """
SELECT event_id, concat_ws('|', CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR)) AS line,
  concat_ws(',', '"' || CAST(event_id AS VARCHAR) || '"', '"' || event_type || '"', '"' || replace(props, '"', '""') || '"') AS quoted FROM events""")
def extract_delimited(t: Tables):
    rows = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "user_id", "event_type",
                           "value", "props")
    return rows.select("event_id", delimited.line(EVENT_COLUMNS, "|").alias("line"),
                       delimited.line(["event_id", "event_type", "props"], ",", quote_all=True).alias("quoted"))


SPLIT_SETTING = "_part{index:03}|16KB|NOZIP"


@query("extract_split_by_size", """
WITH RECURSIVE lines AS (SELECT event_id, strlen(concat_ws(',', CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(user_id AS VARCHAR),
    event_type, CAST(value AS VARCHAR))) + 2 AS b FROM events),
placed AS (SELECT event_id, b, CAST(sum(b) OVER (ORDER BY event_id) AS BIGINT) - b AS start FROM lines),
opened AS (
  SELECT CAST(0 AS BIGINT) AS open_at
  UNION ALL SELECT n.start FROM opened o, LATERAL (SELECT min(p.start) AS start FROM placed p
     WHERE p.start > o.open_at AND p.start + p.b > o.open_at + 16384 - 38) n WHERE n.start IS NOT NULL),
parts AS (SELECT open_at, row_number() OVER (ORDER BY open_at) AS part, lead(open_at) OVER (ORDER BY open_at) AS close_at FROM opened)
SELECT CAST(p.part AS INTEGER) AS part, '_part' || lpad(CAST(p.part AS VARCHAR), 3, '0') AS part_index, count(*) AS n_rows, CAST(sum(c.b) AS BIGINT) AS n_bytes,
  min(c.event_id) AS first_id, max(c.event_id) AS last_id FROM placed c JOIN parts p ON c.start >= p.open_at AND (p.close_at IS NULL OR c.start < p.close_at)
GROUP BY p.part""")
def extract_split_by_size(t: Tables):
    rows = event_rows(t)
    index_format, *_ = text.parse_split_setting(SPLIT_SETTING)
    header = delimited.header_line(EVENT_COLUMNS)
    parts = split.split_by_size(rows, delimited.line(EVENT_COLUMNS), ["event_id"], text.split_limit_bytes(SPLIT_SETTING),
                                len(header.encode()) + split.LINE_END, index_format)
    return parts.groupBy("part", "part_index").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("line_bytes").alias("n_bytes"),
        F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("extract_param_fanout", """
WITH p AS (SELECT DISTINCT c_mktsegment, c_mktsegment AS file_name_part FROM customer WHERE coalesce(c_mktsegment, '') <> '')
SELECT 'SEGMENT_' || file_name_part || '_19980401.csv' AS file_name,
  concat_ws(',', CAST(c_custkey AS VARCHAR), '  ' || c_name || ' ', c.c_mktsegment) AS line FROM customer c JOIN p USING (c_mktsegment)""")
def extract_param_fanout(t: Tables):
    params = t.customer.where("coalesce(c_mktsegment, '') <> ''").select("c_mktsegment").distinct().withColumn(
        "file_name_part", F.col("c_mktsegment"))
    named = delimited.name_by_parameter(t.customer, params, ["c_mktsegment"], "SEGMENT_<FILENAMEPART>_YYYYMMDD.csv",
                                        F.lit(RUN_DATE)).select("file_name", "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"), "c_mktsegment")
    folder = work_path(t.spark, "fanout")
    delimited.write_by_name(named, folder, flags="NO_HEADER")
    return t.spark.read.schema("value string, file_name string").option("lineSep", "\r\n").text(folder).select("file_name", F.col("value").alias("line"))


@query("fixed_width_export", """
SELECT c_custkey, rpad(CAST(c_custkey AS VARCHAR), 10, ' ') || rpad(c_name, 20, ' ') || rpad(substr(c_mktsegment, 1, 6), 6, ' ') AS line,
  rpad(CAST(c_custkey AS VARCHAR), 10, ' ') || substr(c_mktsegment, 1, 8) AS ragged FROM customer""")
def fixed_width_export(t: Tables):
    return t.customer.select(
        "c_custkey", delimited.fixed_width({"c_custkey": 10, "c_name": 20, "c_mktsegment": 6}).alias("line"),
        delimited.fixed_width({"c_custkey": 10, "c_mktsegment": 8}, ragged_right=True).alias("ragged"))


@query("report_name", """
SELECT o_orderkey, 'VISITS_' || o_orderpriority || '_' || strftime(o_orderdate, '%Y%m%d') || '_part' || lpad(CAST(o_orderkey % 7 AS VARCHAR), 3, '0') || '.txt' AS visits_name,
  'PLAN_' || strftime(o_orderdate, '%m%d%Y') || '.txt' AS pfa_name, 'X_' || strftime(o_orderdate, '%Y%m%d%H%M') || '.txt' AS minute_name,
  'Visits_' || strftime(o_orderdate, '%Y.%m') || '.csv' AS month_name, 'Epic_Provider.txt' AS plain_name FROM orders""")
def report_name(t: Tables):
    rows = t.orders.withColumns({
        "index": text.split_index_text("_part{index:03}", F.col("o_orderkey") % 7),
        "month": F.date_format("o_orderdate", "yyyy.MM")})
    at = "o_orderdate"
    return rows.select(
        "o_orderkey",
        text.report_name("VISITS_<FILENAMEPART>_YYYYMMDD{SPLITINDEX}.txt", at, "o_orderpriority", None, "index").alias("visits_name"),
        text.report_name("PLAN_mmddyyyy.txt", at).alias("pfa_name"), text.report_name("X_%Y%m%d%H%M.txt", at).alias("minute_name"),
        text.report_name("Visits_<DATEPART>.csv", at, None, "month").alias("month_name"),
        text.report_name("Epic_Provider.txt", at).alias("plain_name"))


@query("json_flatten", """
SELECT event_id AS id, ts AS meta__at, event_type AS meta__kind, CAST(json_extract(props, '$.k') AS BIGINT) AS props__k FROM events""")
def json_flatten(t: Tables):
    records = nested.parse_json(t.events, "props").select(
        F.col("event_id").alias("id"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"), F.col("event_type").alias("kind")).alias("meta"),
        "props")
    return nested.call_records(records)


@query("json_flatten_mixed", """
SELECT event_id AS id, CASE WHEN event_type = 'view' OR event_id >= 40 AND event_id % 3 = 0 THEN event_type ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS meta__seen, ts AS meta__at FROM events""")
def json_flatten_mixed(t: Tables):
    """A text column of which part is no time keeps all its values as text."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    seen = F.when((F.col("event_type") == "view") | ((F.col("event_id") >= 40) & (F.col("event_id") % 3 == 0)), F.col("event_type")).otherwise(iso)
    return nested.call_records(t.events.select(F.col("event_id").alias("id"), F.struct(
        seen.alias("seen"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at")).alias("meta")))


# ---------------------------------------------------------------- survey load

@query("survey_load", """
SELECT CAST(user_id AS INTEGER) AS surveyid, event_type AS program_name, 'Q' || CAST(event_id % 977 AS VARCHAR) AS question_id, CAST(value AS VARCHAR) AS answer_txt
FROM events e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.ts < TIMESTAMP '2024-01-10' AND x.user_id = e.user_id AND x.event_id % 977 = e.event_id % 977)""")
def survey_load(t: Tables):
    """Write the answers as delimited files, read them back and keep what the table lacks."""
    rows = _survey_rows(t)
    folder = work_path(t.spark, "survey")
    delimited.write_delimited(rows.drop("ts"), folder, "|", encoding="windows-1252")
    return survey.new_answers(t.spark, folder, _survey_target(rows)).select(*survey.SURVEY_COLUMNS)


def _survey_rows(t: Tables):
    return t.events.select(
        F.col("user_id").cast("string").alias("surveyid"), F.col("event_type").alias("program_name"),
        F.concat(F.lit("Q"), F.col("event_id") % 977).alias("question_id"), F.col("value").cast("string").alias("answer_txt"), "ts")


def _survey_target(rows):
    loaded = rows.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz"))
    return loaded.select(F.col("surveyid").cast("int").alias("surveyid"), "question_id")


@query("survey_load_stream", """
SELECT CAST(user_id AS INTEGER) AS surveyid, event_type AS program_name, 'Q' || CAST(event_id % 977 AS VARCHAR) AS question_id, CAST(value AS VARCHAR) AS answer_txt FROM events""")
def survey_load_stream(t: Tables):
    """The same files through the drop-folder stream into an empty table."""
    folder, target, state = (work_path(t.spark, f"survey-{x}") for x in ("in", "table", "state"))
    delimited.write_delimited(_survey_rows(t).drop("ts"), folder, "|", encoding="windows-1252")
    survey.load_stream(t.spark, folder, target, state)
    return t.spark.read.parquet(target).select(*survey.SURVEY_COLUMNS)


# ---------------------------------------------------------------- watermark and audit

def processes(t: Tables):
    status = F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("SUCCESSFUL")
    return t.orders.select(F.col("o_orderkey").alias("process_id"), F.col("o_orderpriority").alias("task_group"),
                           status.alias("status"), F.col("o_orderdate").alias("started"))


def steps(t: Tables):
    return t.lineitem.select(
        F.col("l_orderkey").alias("process_id"), F.col("l_linenumber").alias("step_id"), F.col("l_returnflag").alias("task_name"),
        F.col("l_quantity").cast("long").alias("source_count"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(F.col("l_quantity") - 1).cast("long").alias("target_count"),
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("last_incremental"))


_PROCESS_SQL = """process AS (SELECT o_orderkey AS process_id, o_orderpriority AS task_group, o_orderdate AS started,
  CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'RUNNING' ELSE 'SUCCESSFUL' END AS status FROM orders),
step AS (SELECT l_orderkey AS process_id, l_linenumber AS step_id, l_returnflag AS task_name, CAST(l_quantity AS BIGINT) AS source_count,
  CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE l_quantity - 1 END AS BIGINT) AS target_count,
  CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS last_incremental FROM lineitem)"""


@query("audit_runs", f"""
WITH {_PROCESS_SQL},
shown AS (SELECT 'running' AS view_name, * FROM process WHERE status = 'RUNNING' UNION ALL SELECT 'failed', * FROM process WHERE status = 'FAILED'
  UNION ALL SELECT 'all', * FROM process WHERE task_group = '1-URGENT')
SELECT view_name, process_id, task_group, status, started FROM shown""")
def audit_runs(t: Tables):
    p = processes(t)
    views = [("running", incremental.runs(p, "RUNNING")), ("failed", incremental.runs(p, "FAILED")),
             ("all", incremental.runs(p, group="1-URGENT"))]
    out = None
    for name, df in views:
        one = df.select(F.lit(name).alias("view_name"), "process_id", "task_group", "status", "started")
        out = one if out is None else out.unionByName(one)
    return out


@query("audit_steps", f"""
WITH {_PROCESS_SQL},
last AS (SELECT max(process_id) AS process_id FROM process WHERE status = 'FAILED')
SELECT s.process_id, s.task_name, s.source_count, s.target_count FROM step s JOIN last USING (process_id)""")
def audit_steps(t: Tables):
    """Steps of the last failed run."""
    last = processes(t).where("status = 'FAILED'").agg(F.max("process_id")).first()[0]
    return incremental.run_steps(steps(t), last).select("process_id", "task_name", "source_count", "target_count")


@query("audit_counts", f"""
WITH {_PROCESS_SQL} SELECT p.task_group, s.task_name, count(*) AS n_steps, CAST(sum(s.source_count) AS BIGINT) AS read_rows,
  CAST(sum(s.target_count) AS BIGINT) AS written_rows, count(CASE WHEN s.source_count <> s.target_count THEN 1 END) AS mismatches
FROM process p JOIN step s USING (process_id) GROUP BY ALL""")
def audit_counts(t: Tables):
    joined = processes(t).join(steps(t), "process_id")
    return joined.groupBy("task_group", "task_name").agg(
        F.count(F.lit(1)).alias("n_steps"), F.sum("source_count").alias("read_rows"), F.sum("target_count").alias("written_rows"),
        F.count(F.when(F.col("source_count") != F.col("target_count"), 1)).alias("mismatches"))


_MARKS_SQL = f"""{_PROCESS_SQL},
last_run AS (SELECT task_group, max(process_id) AS process_id FROM process WHERE status = 'SUCCESSFUL' GROUP BY task_group),
task AS (SELECT DISTINCT p.task_group, s.task_name FROM process p JOIN step s USING (process_id)),
mark AS (SELECT t.task_group, t.task_name, coalesce(max(CASE WHEN s.process_id IS NOT NULL THEN coalesce(s.last_incremental, TIMESTAMP '1900-01-01') END),
    TIMESTAMP '1998-03-29') AS watermark
  FROM task t LEFT JOIN last_run r ON r.task_group = t.task_group LEFT JOIN step s ON s.process_id = r.process_id AND s.task_name = t.task_name GROUP BY ALL)"""


def _marks(t: Tables):
    p, s = processes(t), steps(t)
    tasks = p.join(s, "process_id").select("task_group", "task_name").distinct()
    return incremental.watermarks(p, s, tasks, RUN_DATE)


@query("last_watermark", f"WITH {_MARKS_SQL} SELECT * FROM mark")
def last_watermark(t: Tables):
    return _marks(t)


@query("incremental_extract", f"""
WITH {_MARKS_SQL}, rows_in AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, l.l_returnflag, o.o_orderpriority FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_shipdate FROM rows_in r JOIN mark m ON m.task_group = r.o_orderpriority AND m.task_name = r.l_returnflag
WHERE r.l_shipdate > m.watermark""")
def incremental_extract(t: Tables):
    rows = t.lineitem.join(t.orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    new = incremental.newer_rows(rows, "l_shipdate", {"task_group": "o_orderpriority", "task_name": "l_returnflag"}, _marks(t))
    return new.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("audit_task_config", """
SELECT p_partkey AS task_id, p_name AS task_name, p_brand AS task_group, p_size AS priority,
  CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS INTEGER) AS place FROM part WHERE p_type <> 'PROMO'""")
def audit_task_config(t: Tables):
    from pyspark.sql import Window
    config = t.part.select(F.col("p_partkey").alias("task_id"), F.col("p_name").alias("task_name"), F.col("p_brand").alias("task_group"),
                           F.col("p_size").alias("priority"), F.when(F.col("p_type") == "PROMO", 0).otherwise(1).alias("active"))
    listed = incremental.group_config(config.where("active = 1"))
    place = F.row_number().over(Window.partitionBy("task_group").orderBy("priority", "task_id"))
    return listed.select("task_id", "task_name", "task_group", "priority", place.alias("place"))
