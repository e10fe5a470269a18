"""Filters, projections, joins, aggregations and windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import collation, dates, keys, text
from ..operators import aggregates, code_flags, joins, picks
from . import Tables, query

RUN_DATE = dt.date(1998, 4, 1)


# ---------------------------------------------------------------- filters and projections

@query("category_map", """
SELECT o_orderkey,
  CASE WHEN upper(trim(o_orderpriority)) = '1-URGENT' THEN 1 WHEN upper(trim(o_orderpriority)) = '2-HIGH' THEN 2
       WHEN upper(trim(o_orderpriority)) = '3-MEDIUM' THEN 3 WHEN upper(trim(o_orderpriority)) = '4-NOT SPECIFIED' THEN NULL END AS score,
  CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'O' WHEN 'P' THEN 'E' END AS visit_type
FROM orders""")
def category_map(t: Tables):
    p = F.upper(F.trim("o_orderpriority"))
    score = F.when(p == "1-URGENT", 1).when(p == "2-HIGH", 2).when(p == "3-MEDIUM", 3)
    kind = F.when(F.col("o_orderstatus") == "F", "I").when(F.col("o_orderstatus") == "O", "O").when(
        F.col("o_orderstatus") == "P", "E")
    return t.orders.select("o_orderkey", score.alias("score"), kind.alias("visit_type"))


@query("filter_in_list", """
SELECT p_partkey, p_brand, p_type FROM part
WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#23') AND p_type NOT IN ('PROMO', 'LARGE')""")
def filter_in_list(t: Tables):
    return t.part.where(
        F.col("p_brand").isin("Brand#1", "Brand#12", "Brand#23") & ~F.col("p_type").isin("PROMO", "LARGE")
    ).select("p_partkey", "p_brand", "p_type")


@query("like_family", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE (p_name ILIKE '%red%' OR p_name ILIKE 'Small%') AND NOT (p_brand ILIKE '%brand#1%' OR p_brand ILIKE '%#25')""")
def like_family(t: Tables):
    return t.part.where(
        text.like_any("p_name", ["%Red%", "SMALL%"]) & text.not_like_all("p_brand", ["%BRAND#1%", "%#25"])
    ).select("p_partkey", "p_name", "p_brand")


@query("ilike_any", """
SELECT p_type, count(*) AS n FROM part
WHERE p_type ILIKE 'promo' OR p_type ILIKE '%arge' OR p_type ILIKE 'econ%' GROUP BY p_type""")
def ilike_any(t: Tables):
    return t.part.where("p_type ilike any ('promo', '%arge', 'econ%')").groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("sentinel_filter", """
SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last_key FROM orders
WHERE o_orderkey > 0 AND o_custkey > 1 GROUP BY o_orderstatus""")
def sentinel_filter(t: Tables):
    return t.orders.where(keys.real_key("o_orderkey") & keys.real_key("o_custkey", 1)).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_key"))


@query("scd2_current", """
WITH dim AS (SELECT c_custkey AS durable_key, c_name AS name, CASE WHEN c_acctbal < 500 THEN 0 ELSE 1 END AS is_current,
  CASE WHEN c_nationkey = 7 THEN 0 ELSE 1 END AS is_valid, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Deceased' ELSE 'Alive' END AS status FROM customer)
SELECT o.o_orderkey, d.name FROM orders o
LEFT JOIN dim d ON d.durable_key = o.o_custkey AND d.is_current = 1 AND d.is_valid = 1 AND d.status <> 'Deceased'""")
def scd2_current(t: Tables):
    dim = t.customer.select(
        F.col("c_custkey").alias("durable_key"), F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 500, 0).otherwise(1).alias("is_current"),
        F.when(F.col("c_nationkey") == 7, 0).otherwise(1).alias("is_valid"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "Deceased").otherwise("Alive").alias("status"))
    live = keys.current_rows(dim, valid="is_valid", status="status")
    return t.orders.join(live, F.col("o_custkey") == F.col("durable_key"), "left").select("o_orderkey", "name")


@query("active_on_date", """
WITH e AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS end_date FROM orders)
SELECT o_orderkey, CAST(end_date AS VARCHAR) AS end_date FROM e WHERE end_date >= DATE '1998-04-01' OR end_date IS NULL""")
def active_on_date(t: Tables):
    e = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")).alias("end_date"))
    return e.where(keys.active_on("end_date", RUN_DATE))


@query("relative_date_filter", """
SELECT 'last_2_years' AS rule, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1996-04-01'
UNION ALL SELECT 'exactly_3_days_ago', count(*) FROM orders WHERE date_diff('day', o_orderdate, DATE '1998-04-01') = 3
UNION ALL SELECT 'today_or_later', count(*) FROM orders WHERE o_orderdate >= DATE '1998-04-01'""")
def relative_date_filter(t: Tables):
    rules = {
        "last_2_years": dates.within_last_years("o_orderdate", RUN_DATE, 2),
        "exactly_3_days_ago": dates.exactly_days_ago("o_orderdate", RUN_DATE, 3),
        "today_or_later": F.col("o_orderdate") >= F.lit(RUN_DATE),
    }
    one = t.orders.agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(r) for r, c in rules.items()])
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("n")) for r in rules])
    return one.select(F.inline(pairs))


@query("day_between", """
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""")
def day_between(t: Tables):
    return t.events.where(dates.day_between("ts", dt.date(2024, 1, 10), dt.date(2024, 1, 12))).select("event_id", "event_type")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("exists_flag", """
SELECT c.c_custkey,
  CASE WHEN EXISTS (SELECT 1 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
                    WHERE o.o_custkey = c.c_custkey AND p.p_type LIKE 'PRO%' AND l.l_quantity >= 45) THEN 1 ELSE 0 END AS has_promo,
  CASE WHEN EXISTS (SELECT 1 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
                    WHERE o.o_custkey = c.c_custkey AND p.p_brand LIKE 'Brand#25%') THEN 1 ELSE 0 END AS has_brand25
FROM customer c""")
def exists_flag(t: Tables):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joins.exists_flag(
        t.customer.select("c_custkey"), lines.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", {
            "has_promo": F.col("p_type").like("PRO%") & (F.col("l_quantity") >= 45),
            "has_brand25": F.col("p_brand").like("Brand#25%")})


# ---------------------------------------------------------------- joins

@query("join_inner", """
SELECT n.n_name, count(*) AS n, max(o.o_totalprice) AS max_price FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY n.n_name""")
def join_inner(t: Tables):
    # Orders are reduced per customer before they meet the dimensions.
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("p"))
    return (per.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.sum("n").alias("n"), F.max("p").alias("max_price")))


@query("join_left", """
SELECT c.c_custkey, c.c_name, e.event_id, e.event_type FROM customer c LEFT JOIN events e ON e.user_id = c.c_custkey""")
def join_left(t: Tables):
    return t.customer.join(t.events, F.col("c_custkey") == F.col("user_id"), "left").select(
        "c_custkey", "c_name", "event_id", "event_type")


@query("join_left_on_pred", """
SELECT o.o_orderkey, l.l_suppkey, l.l_quantity FROM orders o
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_linenumber = 1 AND l.l_returnflag = 'A'""")
def join_left_on_pred(t: Tables):
    first = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    keep = (F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "A")
    return joins.left_join_where(t.orders, first, ["o_orderkey"], keep).select("o_orderkey", "l_suppkey", "l_quantity")


@query("join_left_null_reject", """
SELECT o.o_orderkey, p.p_name FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON p.p_partkey = l.l_partkey WHERE l.l_quantity > 49 AND p.p_type NOT LIKE '%PROMO%'""")
def join_left_null_reject(t: Tables):
    lines = t.lineitem.where("l_quantity > 49")
    return (t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(t.part.where(~F.col("p_type").like("%PROMO%")), F.col("l_partkey") == F.col("p_partkey"))
            .select("o_orderkey", "p_name"))


@query("self_join", """
SELECT s.s_suppkey, g.s_suppkey AS plan_key, g.s_name AS plan_name FROM supplier s
JOIN (SELECT s_nationkey, min(s_suppkey) AS k FROM supplier GROUP BY s_nationkey) m ON m.s_nationkey = s.s_nationkey
JOIN supplier g ON g.s_suppkey = m.k""")
def self_join(t: Tables):
    plan = picks.earliest_per(t.supplier, ["s_nationkey"], "s_suppkey", []).select(
        "s_nationkey", F.col("s_suppkey").alias("plan_key"), F.col("s_name").alias("plan_name"))
    return t.supplier.join(plan, "s_nationkey").select("s_suppkey", "plan_key", "plan_name")


COVERAGE_SLOTS_SQL = """
slot_lines AS (
  SELECT o.o_custkey AS patient_key, l.l_linenumber AS line, l.l_suppkey,
    row_number() OVER (PARTITION BY o.o_custkey, l.l_linenumber ORDER BY l.l_shipdate, o.o_orderkey, l.l_suppkey, l.l_partkey) AS rn
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_linenumber IN (1, 2, 3)),
coverage_slots AS (
  SELECT patient_key, max(CASE WHEN line = 1 THEN l_suppkey END) AS first_key, max(CASE WHEN line = 2 THEN l_suppkey END) AS second_key,
    max(CASE WHEN line = 3 THEN l_suppkey END) AS third_key FROM slot_lines WHERE rn = 1 GROUP BY patient_key)"""


def coverage_slots(t: Tables):
    """One row per patient with the suppliers of its earliest line 1, 2 and 3."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumnRenamed("o_custkey", "patient_key")
    return aggregates.slot_pivot(
        lines, ["patient_key"], "l_linenumber", ["l_shipdate", "o_orderkey", "l_suppkey", "l_partkey"],
        {"key": "l_suppkey"}, {1: "first", 2: "second", 3: "third"})


@query("slot_pivot", f"WITH {COVERAGE_SLOTS_SQL} SELECT * FROM coverage_slots")
def slot_pivot(t: Tables):
    return coverage_slots(t)


@query("join_coalesced_key", f"""
WITH {COVERAGE_SLOTS_SQL},
src AS (SELECT patient_key, CASE WHEN patient_key % 3 = 0 THEN third_key END AS member_key,
          CASE WHEN patient_key % 2 = 0 THEN first_key END AS own_key, second_key AS external_key FROM coverage_slots)
SELECT src.patient_key, s.s_suppkey AS coverage_key, s.s_name AS plan_name FROM src
LEFT JOIN supplier s ON s.s_suppkey = coalesce(src.member_key, src.own_key, src.external_key)""")
def join_coalesced_key(t: Tables):
    k = F.col("patient_key")
    src = coverage_slots(t).select(
        k, F.when(k % 3 == 0, F.col("third_key")).alias("member_key"),
        F.when(k % 2 == 0, F.col("first_key")).alias("own_key"), F.col("second_key").alias("external_key"))
    return joins.join_first_key(src, t.supplier, ["member_key", "own_key", "external_key"], "s_suppkey").select(
        "patient_key", F.col("s_suppkey").alias("coverage_key"), F.col("s_name").alias("plan_name"))


@query("lookup_chain", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, s.s_name AS provider, n.n_name AS state, r.r_name AS area FROM lineitem l
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def lookup_chain(t: Tables):
    out = joins.lookups(t.lineitem, [
        (t.supplier, "l_suppkey", "s_suppkey", {"provider": "s_name", "_nation": "s_nationkey"}),
        (t.nation, "_nation", "n_nationkey", {"state": "n_name", "_region": "n_regionkey"}),
        (t.region, "_region", "r_regionkey", {"area": "r_name"})])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "provider", "state", "area")


@query("anti_join_append", """
WITH target AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < DATE '1998-01-01'),
stage AS (SELECT * FROM orders WHERE o_orderdate >= DATE '1998-01-01')
SELECT s.o_orderkey, s.o_custkey, s.o_orderpriority FROM stage s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_custkey = s.o_custkey AND t.o_orderpriority = s.o_orderpriority)""")
def anti_join_append(t: Tables):
    cut = F.lit(dt.date(1998, 1, 1))
    stage = t.orders.where(F.col("o_orderdate") >= cut)
    target = t.orders.where(F.col("o_orderdate") < cut)
    return joins.anti_append(stage, target, ["o_custkey", "o_orderpriority"]).select(
        "o_orderkey", "o_custkey", "o_orderpriority")


# ---------------------------------------------------------------- aggregations

@query("agg_max", """
SELECT o_custkey, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_visit, max(o_totalprice) AS max_cost FROM orders GROUP BY o_custkey""")
def agg_max(t: Tables):
    return t.orders.groupBy("o_custkey").agg(
        F.max(F.to_date("o_orderdate")).alias("last_visit"), F.max("o_totalprice").alias("max_cost"))


@query("agg_distinct", """
SELECT s.s_nationkey, l.l_returnflag, max(l.l_shipdate) AS last_ship FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
GROUP BY s.s_nationkey, l.l_returnflag""")
def agg_distinct(t: Tables):
    per = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.max("l_shipdate").alias("d"))
    return per.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_nationkey", "l_returnflag").agg(
        F.max("d").alias("last_ship"))


@query("eav_pivot", """
SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'view' THEN value END) AS view_value,
  max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase FROM events GROUP BY user_id""")
def eav_pivot(t: Tables):
    return aggregates.eav_pivot(t.events, ["user_id"], "event_type", "value",
                                {"click": "click", "view": "view_value", "purchase": "purchase"})


@query("code_prefix_flags", """
SELECT l.l_orderkey,
  max(CASE WHEN p.p_brand LIKE 'Brand#1%' THEN 1 ELSE 0 END) AS brand_1x, max(CASE WHEN p.p_brand LIKE 'Brand#2%' THEN 1 ELSE 0 END) AS brand_2x,
  max(CASE WHEN p.p_brand = 'Brand#5' OR p.p_brand LIKE 'Brand#25%' THEN 1 ELSE 0 END) AS brand_5s,
  max(CASE WHEN p.p_type LIKE '%PROMO%' THEN 1 ELSE 0 END) AS promo, max(CASE WHEN p.p_type LIKE '%ECONOMY%' THEN 1 ELSE 0 END) AS economy,
  max(CASE WHEN p.p_type LIKE '%LARGE%' THEN 1 ELSE 0 END) AS large
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey""")
def code_prefix_flags(t: Tables):
    flags = ["brand_1x", "brand_2x", "brand_5s", "promo", "economy", "large"]
    rows = [("brand_1x", "prefix", "Brand#1"), ("brand_2x", "prefix", "Brand#2"), ("brand_5s", "exact", "Brand#5"),
            ("brand_5s", "prefix", "Brand#25")]
    patterns = code_flags.pattern_table(t.spark, flags, rows)
    words = [(3, F.col("p_type").like("%PROMO%")), (4, F.col("p_type").like("%ECONOMY%")), (5, F.col("p_type").like("%LARGE%"))]
    coded = code_flags.code_masks(t.part, "p_brand", patterns, [7, 8], words)
    per = code_flags.masks_per(t.lineitem.join(coded, F.col("l_partkey") == F.col("p_partkey")), ["l_orderkey"])
    return per.select("l_orderkey", *code_flags.flag_columns(flags))


_LINES_PARTS = "lineitem l JOIN part p ON p.p_partkey = l.l_partkey"


def _lines_parts(t: Tables):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))


@query("listagg_ordered", f"""
SELECT l.l_orderkey, string_agg(p.p_brand, ',' ORDER BY l.l_shipdate DESC, p.p_brand DESC) AS brands FROM {_LINES_PARTS} GROUP BY l.l_orderkey""")
def listagg_ordered(t: Tables):
    return aggregates.list_ordered(_lines_parts(t), ["l_orderkey"], "p_brand", ["l_shipdate"], "brands", descending=True)


@query("listagg_hot_key", """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_suppkey END AS k, string_agg(CAST(l_quantity AS BIGINT) || '/' || l_linenumber, ';' ORDER BY l_shipdate, CAST(l_quantity AS BIGINT) || '/' || l_linenumber) AS lines
FROM lineitem GROUP BY ALL""")
def listagg_hot_key(t: Tables):
    """One key holds a third of all rows."""
    k = F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_suppkey"))
    rows = t.lineitem.select(k.alias("k"), "l_shipdate", F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string")).alias("v"))
    return aggregates.list_ordered_blocks(rows, ["k"], "v", ["l_shipdate"], "lines", sep=";")


@query("collated_join", """
WITH c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN c_mktsegment || '  ' ELSE c_mktsegment END AS segment FROM customer),
l AS (SELECT DISTINCT c_mktsegment AS segment, CASE WHEN c_mktsegment < 'C' THEN upper(c_mktsegment) || ' ' ELSE lower(c_mktsegment) END AS listed FROM customer)
SELECT 'any case and blanks' AS rule, c_custkey, l.segment, count(*) OVER (PARTITION BY lower(rtrim(c.segment, ' '))) AS n_same,
  CAST(lower(rtrim(c.segment, ' ')) IN ('building', 'machinery') AS INTEGER) AS in_list
FROM c JOIN l ON lower(rtrim(c.segment, ' ')) = lower(rtrim(l.listed, ' '))
UNION ALL SELECT 'blanks only', c_custkey, l.segment, count(*) OVER (PARTITION BY rtrim(c.segment, ' ')), CAST(rtrim(c.segment, ' ') IN ('BUILDING', 'MACHINERY') AS INTEGER)
FROM c JOIN l ON rtrim(c.segment, ' ') = rtrim(l.listed, ' ')""")
def collated_join(t: Tables):
    """Join, count and IN on columns that carry the comparison rule of their source, in both modes."""
    segment = F.when(F.col("c_custkey") % 3 == 0, F.lower("c_mktsegment")).when(F.col("c_custkey") % 3 == 1, F.concat("c_mktsegment", F.lit("  "))).otherwise(F.col("c_mktsegment"))
    rows = t.customer.select("c_custkey", segment.alias("named"))
    listed = t.customer.select("c_mktsegment").distinct().select(F.col("c_mktsegment").alias("segment"), F.when(
        F.col("c_mktsegment") < "C", F.concat(F.upper("c_mktsegment"), F.lit(" "))).otherwise(F.lower("c_mktsegment")).alias("named"))
    out = None
    for rule, ignore_case in (("any case and blanks", True), ("blanks only", False)):
        a, b = (collation.collate_columns(df, ["named"], ignore_case) for df in (rows, listed))
        wanted = F.col("named").isin("building", "machinery") if ignore_case else F.col("named").isin("BUILDING", "MACHINERY")
        one = picks.count_per(a.join(b, "named"), ["named"], "n_same").select(
            F.lit(rule).alias("rule"), "c_custkey", "segment", "n_same", wanted.cast("int").alias("in_list"))
        out = one if out is None else out.unionByName(one)
    return out


@query("listagg_distinct", f"""
SELECT l.l_suppkey, string_agg(DISTINCT p.p_brand, ' || ' ORDER BY p.p_brand) AS brands,
  string_agg(DISTINCT p.p_type, ' || ' ORDER BY p.p_type) AS types FROM {_LINES_PARTS} GROUP BY l.l_suppkey""")
def listagg_distinct(t: Tables):
    return aggregates.list_distinct(_lines_parts(t), ["l_suppkey"], {"brands": "p_brand", "types": "p_type"})


@query("listagg_case", f"""
SELECT l.l_orderkey,
  string_agg(DISTINCT CASE WHEN p.p_type = 'PROMO' THEN p.p_name END, ' || ' ORDER BY CASE WHEN p.p_type = 'PROMO' THEN p.p_name END) AS promo_names,
  string_agg(DISTINCT CASE WHEN p.p_type = 'LARGE' THEN p.p_name END, ' || ' ORDER BY CASE WHEN p.p_type = 'LARGE' THEN p.p_name END) AS large_names
FROM {_LINES_PARTS} GROUP BY l.l_orderkey""")
def listagg_case(t: Tables):
    return aggregates.list_distinct(_lines_parts(t), ["l_orderkey"], {
        "promo_names": F.when(F.col("p_type") == "PROMO", F.col("p_name")),
        "large_names": F.when(F.col("p_type") == "LARGE", F.col("p_name"))})


@query("header_detail_trailer", """
WITH d AS (SELECT CAST(c_custkey AS VARCHAR) AS subscriber_id, c_name AS first_name, c_mktsegment AS last_name FROM customer WHERE c_acctbal > 5000),
n AS (SELECT count(*) AS n FROM d)
SELECT 1 AS record_order, 'HR' AS subscriber_id, '19980401' AS first_name, '' AS last_name FROM n WHERE n > 0
UNION ALL SELECT 2, subscriber_id, first_name, last_name FROM d
UNION ALL SELECT 3, 'TR', '19980401', CAST(n AS VARCHAR) FROM n WHERE EXISTS (SELECT 1 FROM customer)""")
def header_detail_trailer(t: Tables):
    members = t.customer.select(
        F.col("c_custkey").cast("string").alias("subscriber_id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"), "c_acctbal")
    detail = members.where("c_acctbal > 5000")
    return aggregates.header_detail_trailer(detail, members, RUN_DATE.strftime("%Y%m%d"),
                                            ["subscriber_id", "first_name", "last_name"])


# ---------------------------------------------------------------- windows

@query("latest_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM
 (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_per_key(t: Tables):
    return picks.latest_per(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


@query("earliest_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM
 (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def earliest_per_key(t: Tables):
    return picks.earliest_per(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


@query("latest_per_category", f"""
SELECT o_custkey, p_brand, l_shipdate, l_quantity FROM
 (SELECT o.o_custkey, p.p_brand, l.l_shipdate, l.l_quantity, row_number() OVER (PARTITION BY o.o_custkey, p.p_brand
    ORDER BY l.l_shipdate DESC, l.l_quantity DESC) AS rn FROM {_LINES_PARTS} JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE p.p_brand LIKE 'Brand#1%' OR p.p_brand LIKE 'Brand#2%') WHERE rn = 1""")
def latest_per_category(t: Tables):
    brands = t.part.where(text.like_any("p_brand", ["Brand#1%", "Brand#2%"], ignore_case=False)).select("p_partkey", "p_brand")
    lines = t.lineitem.join(brands, F.col("l_partkey") == F.col("p_partkey")).join(
        t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return picks.latest_per(lines, ["o_custkey", "p_brand"], "l_shipdate", ["l_quantity"]).select(
        "o_custkey", "p_brand", "l_shipdate", "l_quantity")


@query("lead_next", """
SELECT o_orderkey, lead(o_orderdate, 1) OVER w AS next_date, lead(o_orderstatus, 1) OVER w AS next_status FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def lead_next(t: Tables):
    return picks.next_row(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                          {"next_date": "o_orderdate", "next_status": "o_orderstatus"}).select(
        "o_orderkey", "next_date", "next_status")


@query("count_over", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS patient_rows FROM orders")
def count_over(t: Tables):
    return picks.count_per(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "patient_rows").select(
        "o_orderkey", "patient_rows")


# ---------------------------------------------------------------- scalar functions

@query("boundary_diff", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
  CAST(date_diff('year', o.o_orderdate, l.l_shipdate) AS INTEGER) AS years, CAST(date_diff('month', o.o_orderdate, l.l_shipdate) AS INTEGER) AS months,
  CAST(date_diff('day', date_trunc('week', o.o_orderdate), date_trunc('week', l.l_shipdate)) / 7 AS INTEGER) AS weeks,
  CAST(date_diff('day', o.o_orderdate, l.l_shipdate) AS INTEGER) AS days, CAST(date_diff('minute', o.o_orderdate, l.l_shipdate) AS BIGINT) AS minutes
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def boundary_diff(t: Tables):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    units = [("years", "year"), ("months", "month"), ("weeks", "week"), ("days", "day"), ("minutes", "minute")]
    return j.select("l_orderkey", "l_linenumber", "l_partkey",
                    *[dates.boundary_diff(u, "o_orderdate", "l_shipdate").alias(n) for n, u in units])


@query("scalar_text", """
SELECT c_custkey, concat(coalesce(c_name, ''), ' ', coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END, ''), ' ', 'HMO') AS glued,
  c_name || CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS strict_glued,
  CASE WHEN strpos(n, ',') > 1 THEN substr(n, 1, strpos(n, ',') - 1) END AS last_name,
  CASE WHEN strpos(n, ',') = 0 THEN NULL WHEN strpos(ltrim(substr(n, strpos(n, ',') + 1)), ' ') > 0
    THEN split_part(ltrim(substr(n, strpos(n, ',') + 1)), ' ', 1) ELSE ltrim(substr(n, strpos(n, ',') + 1)) END AS first_name,
  substr(c_name, 4) AS short_id, CASE WHEN regexp_matches(substr(c_name, 10, 2), '^[0-9]+$') THEN 1 ELSE 0 END AS is_number,
  CAST(2024 - 1950 - CASE WHEN CAST('1950-01-01' AS DATE) + CAST(c_custkey % 366 AS INTEGER) + INTERVAL 74 YEARS > DATE '2024-06-15' THEN 1 ELSE 0 END AS INTEGER) AS age
FROM (SELECT *, CASE c_custkey % 4 WHEN 0 THEN c_mktsegment || ', ' || substr(c_name, 1, 8) || ' A' WHEN 1 THEN c_mktsegment || ',' || substr(c_name, 1, 8)
   WHEN 2 THEN ',' || c_mktsegment ELSE c_name END AS n FROM customer)""")
def scalar_text(t: Tables):
    k = F.col("c_custkey")
    seg = F.when(k % 3 > 0, F.col("c_mktsegment"))
    eight = F.substring("c_name", 1, 8)
    n = F.when(k % 4 == 0, F.concat("c_mktsegment", F.lit(", "), eight, F.lit(" A"))).when(
        k % 4 == 1, F.concat("c_mktsegment", F.lit(","), eight)).when(
        k % 4 == 2, F.concat(F.lit(","), "c_mktsegment")).otherwise(F.col("c_name"))
    last, first = text.split_name(n)
    birth = F.date_add(F.lit(dt.date(1950, 1, 1)), (k % 366).cast("int"))
    return t.customer.select(
        k, text.concat_tsql("c_name", F.lit(" "), seg, F.lit(" "), F.lit("HMO")).alias("glued"),
        text.concat_strict("c_name", seg).alias("strict_glued"), last.alias("last_name"), first.alias("first_name"),
        text.drop_first("c_name", 3).alias("short_id"),
        text.tsql_isnumeric(F.substring("c_name", 10, 2)).alias("is_number"),
        dates.age_at(birth, F.lit(dt.date(2024, 6, 15))).alias("age"))


@query("month_grid", """
WITH grid AS (SELECT DATE '1998-04-01' AS run_date, n_nationkey, n_name FROM nation),
w AS (SELECT *, CASE n_nationkey % 3 WHEN 0 THEN 'Last day of prior month' WHEN 1 THEN '15th of prior month-1' END AS window_end_rule,
   CASE n_nationkey % 5 WHEN 0 THEN '1 Month' WHEN 1 THEN '2 Months' WHEN 2 THEN '45 Days' WHEN 3 THEN 'Modified 2 Months' END AS lookback_rule FROM grid),
e AS (SELECT *, CASE window_end_rule WHEN 'Last day of prior month' THEN DATE '1998-03-31' WHEN '15th of prior month-1' THEN DATE '1998-03-15' ELSE DATE '2099-01-01' END AS window_end FROM w)
SELECT n_nationkey, '1998-02-01' AS two_back, '1998-05-15' AS next_mid, CAST(window_end AS VARCHAR) AS window_end,
  CAST(CAST(CASE WHEN lookback_rule = '1 Month' AND n_nationkey % 3 = 1 THEN date_trunc('month', window_end) - INTERVAL 1 MONTH + INTERVAL 14 DAY
   WHEN lookback_rule = '1 Month' THEN date_trunc('month', window_end)
   WHEN lookback_rule IN ('2 Months', 'Modified 2 Months') AND n_nationkey % 3 = 1 THEN date_trunc('month', window_end) - INTERVAL 2 MONTH + INTERVAL 14 DAY
   WHEN lookback_rule IN ('2 Months', 'Modified 2 Months') THEN date_trunc('month', window_end) - INTERVAL 2 MONTH
   WHEN lookback_rule = '45 Days' AND n_nationkey % 3 = 1 THEN date_trunc('month', window_end) - INTERVAL 1 MONTH
   WHEN lookback_rule = '45 Days' THEN date_trunc('month', window_end) - INTERVAL 1 MONTH + INTERVAL 14 DAY
   ELSE DATE '2099-01-01' END AS DATE) AS VARCHAR) AS lookback_start FROM e""")
def month_grid(t: Tables):
    from ..plans.billing import lookback_start, window_end
    k = F.col("n_nationkey")
    plans = t.nation.withColumns({
        "run_date": F.lit(RUN_DATE),
        "end_rule": F.when(k % 3 == 0, "Last day of prior month").when(k % 3 == 1, "15th of prior month-1"),
        "back_rule": F.when(k % 5 == 0, "1 Month").when(k % 5 == 1, "2 Months").when(k % 5 == 2, "45 Days").when(
            k % 5 == 3, "Modified 2 Months")})
    grid = dates.month_grid("run_date")
    ended = plans.withColumn("window_end", window_end("end_rule", grid))
    return ended.select("n_nationkey", grid["m2_begin"].alias("two_back"), grid["p1_mid"].alias("next_mid"), "window_end",
                        lookback_start("back_rule", "end_rule", "window_end").alias("lookback_start"))
