"""As-of, nearest, interval and follow-up matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, asof, followup, intervals
from . import Tables, query

FLAGS = {"A": "a", "N": "n", "R": "r"}


def results(t: Tables):
    """Line items as dated results of a patient."""
    return t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))


def _asof_sql(op: str, direction: str) -> str:
    picks = ", ".join(
        f"max(CASE WHEN rf = '{f}' THEN l_shipdate END) AS {c}_time, max(CASE WHEN rf = '{f}' THEN l_quantity END) AS {c}_quantity, "
        f"max(CASE WHEN rf = '{f}' THEN l_orderkey END) AS {c}_source" for f, c in FLAGS.items())
    tie = f"l.l_orderkey {direction}, l.l_linenumber {direction}, l.l_quantity {direction}, l.l_partkey {direction}"
    return f"""
WITH ranked AS (
  SELECT o.o_orderkey, l.l_returnflag AS rf, l.l_shipdate, l.l_quantity, l.l_orderkey,
    row_number() OVER (PARTITION BY o.o_orderkey, l.l_returnflag ORDER BY l.l_shipdate {direction}, {tie}) AS rn
  FROM orders o JOIN orders o2 ON o2.o_custkey = o.o_custkey JOIN lineitem l ON l.l_orderkey = o2.o_orderkey
  WHERE l.l_shipdate {op} o.o_orderdate),
wide AS (SELECT o_orderkey, {picks} FROM ranked WHERE rn = 1 GROUP BY o_orderkey)
SELECT o.o_orderkey, w.* EXCLUDE (o_orderkey) FROM orders o LEFT JOIN wide w ON w.o_orderkey = o.o_orderkey"""


def _asof(t: Tables, direction: str):
    out = asof.asof(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), results(t), key="o_custkey", left_time="o_orderdate",
        right_time="l_shipdate", values=["l_quantity", "l_orderkey"],
        tiebreak=["l_orderkey", "l_linenumber", "l_quantity", "l_partkey"], direction=direction,
        category="l_returnflag", categories=FLAGS)
    cols = [F.col(f"{c}.{f}").alias(f"{c}_{n}") for c in FLAGS.values()
            for f, n in (("time", "time"), ("l_quantity", "quantity"), ("l_orderkey", "source"))]
    return out.select("o_orderkey", *cols)


@query("asof_backward", _asof_sql("<=", "DESC"))
def asof_backward(t: Tables):
    return _asof(t, "backward")


@query("asof_forward", _asof_sql(">=", "ASC"))
def asof_forward(t: Tables):
    return _asof(t, "forward")


@query("nearest_join", """
WITH e AS (SELECT user_id, event_id, event_type, ts - INTERVAL 24 YEARS AS at FROM events),
ranked AS (SELECT o.o_orderkey, e.event_id, e.event_type, e.at,
   row_number() OVER (PARTITION BY o.o_orderkey ORDER BY abs(epoch_us(e.at) - epoch_us(o.o_orderdate)), e.at, e.event_id) AS rn
 FROM orders o JOIN e ON e.user_id = o.o_custkey)
SELECT o.o_orderkey, r.event_id, r.event_type, r.at FROM orders o LEFT JOIN ranked r ON r.o_orderkey = o.o_orderkey AND r.rn = 1""")
def nearest_join(t: Tables):
    e = t.events.select(F.col("user_id").alias("o_custkey"), "event_id", "event_type",
                        (F.col("ts") - F.expr("INTERVAL 24 YEARS")).alias("at"))
    near = asof.nearest(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), e, key="o_custkey",
                        left_time="o_orderdate", right_time="at", values=["event_id", "event_type"], tiebreak=["event_id"])
    return near.select("o_orderkey", "near.event_id", "near.event_type", F.col("near.time").alias("at"))


@query("nearest_flowsheet", """
WITH flow AS (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS day, value FROM events WHERE event_type IN ('click', 'view')),
device AS (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS day, value FROM events WHERE event_type IN ('signup', 'purchase')),
ranked AS (SELECT f.event_id, d.event_id AS device_id, d.ts AS device_ts, d.value AS device_value,
   row_number() OVER (PARTITION BY f.event_id ORDER BY abs(epoch_us(d.ts) - epoch_us(f.ts)), d.ts, d.event_id) AS rn
 FROM flow f JOIN device d ON d.user_id = f.user_id AND d.day = f.day)
SELECT f.event_id, r.device_id, r.device_ts, r.device_value FROM flow f LEFT JOIN ranked r ON r.event_id = f.event_id AND r.rn = 1""")
def nearest_flowsheet(t: Tables):
    """Device row nearest to each flowsheet row of the same encounter and day."""
    def side(kinds):
        return t.events.where(F.col("event_type").isin(kinds)).withColumn(
            "stay", F.struct("user_id", F.to_date("ts").alias("day")))
    flow = side(["click", "view"]).select("event_id", "stay", "ts")
    device = side(["signup", "purchase"]).select("stay", F.col("ts").alias("at"), F.col("event_id").alias("line"), "value")
    near = asof.nearest(flow, device, key="stay", left_time="ts", right_time="at", values=["line", "value"],
                        tiebreak=["line"])
    return near.select("event_id", F.col("near.line").alias("device_id"), F.col("near.time").alias("device_ts"),
                       F.col("near.value").alias("device_value"))


@query("join_range_after", """
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o.o_orderkey, (SELECT string_agg(CAST(d.day AS VARCHAR), ',' ORDER BY d.day) FROM d
   WHERE d.o_custkey = o.o_custkey AND d.day > CAST(o.o_orderdate AS DATE)) AS later_dates FROM orders o""")
def join_range_after(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return intervals.later_days(orders, t.orders, key="o_custkey", left_date="o_orderdate", right_date="o_orderdate",
                                out="later_dates").select("o_orderkey", "later_dates")


@query("interval_join", """
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, min(o_orderpriority) AS reason FROM orders GROUP BY ALL),
m AS (SELECT o.o_orderkey, d.day, d.reason, date_diff('day', CAST(o.o_orderdate AS DATE), d.day) AS gap FROM orders o
      JOIN d ON d.o_custkey = o.o_custkey AND date_diff('day', CAST(o.o_orderdate AS DATE), d.day) BETWEEN 1 AND 90)
SELECT o_orderkey, string_agg(CASE WHEN gap <= 30 THEN CAST(day AS VARCHAR) END, ', ' ORDER BY day) AS dates_30,
  string_agg(CASE WHEN gap <= 30 THEN reason END, ', ' ORDER BY day) AS reasons_30,
  string_agg(CASE WHEN gap > 30 THEN CAST(day AS VARCHAR) END, ', ' ORDER BY day) AS dates_90,
  string_agg(CASE WHEN gap > 30 THEN reason END, ', ' ORDER BY day) AS reasons_90 FROM m GROUP BY o_orderkey""")
def interval_join(t: Tables):
    lists = readmission_lists(
        t.orders.select("o_custkey", F.to_date("o_orderdate").alias("index_day")),
        t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("reason")),
        "o_custkey")
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("index_day"))
    return orders.join(lists, ["o_custkey", "index_day"]).drop("o_custkey", "index_day")


def readmission_lists(index, admissions, key):
    from ..plans.cohort import readmission_lists as lists
    return lists(index, admissions, key)


@query("followup_buckets", """
WITH e AS (SELECT o.o_orderkey, l.l_returnflag AS component, l.l_shipdate, l.l_quantity, l.l_orderkey, l.l_linenumber, l.l_partkey,
  CASE WHEN date_diff('day', date_trunc('week', o.o_orderdate), date_trunc('week', l.l_shipdate)) = 7 THEN 'w1'
    WHEN date_diff('month', o.o_orderdate, l.l_shipdate) = 1 THEN 'm1' WHEN date_diff('month', o.o_orderdate, l.l_shipdate) = 3 THEN 'm3'
    WHEN date_diff('month', o.o_orderdate, l.l_shipdate) = 6 THEN 'm6' WHEN date_diff('year', o.o_orderdate, l.l_shipdate) = 1 THEN 'y1'
    WHEN date_diff('year', o.o_orderdate, l.l_shipdate) >= 1 THEN 'ygt1' END AS bucket
  FROM orders o JOIN orders o2 ON o2.o_custkey = o.o_custkey JOIN lineitem l ON l.l_orderkey = o2.o_orderkey AND l.l_shipdate >= o.o_orderdate),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, component, bucket
   ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_partkey DESC) AS rn FROM e WHERE bucket IS NOT NULL)
SELECT o_orderkey, component, bucket, l_shipdate AS at, l_quantity FROM r WHERE rn = 1""")
def followup_buckets(t: Tables):
    cases = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    picked = followup.followup_buckets(
        cases, results(t), key="o_custkey", index_time="o_orderdate", component="l_returnflag", time="l_shipdate",
        values=["l_quantity"], tiebreak=["l_orderkey", "l_linenumber", "l_quantity", "l_partkey"], carry=["o_orderkey"])
    return picked.select("o_orderkey", F.col("l_returnflag").alias("component"), "bucket", F.col("time").alias("at"), "l_quantity")
