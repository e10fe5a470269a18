"""Rosters, parent companies, charges and per-payer reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import billing, charges, payer_reports, rosters
from . import Tables, query
from .basics import RUN_DATE
from .warehouse import REVENUE_SQL, choice, patient, revenue_tables, sql_choice

_LIKE = lambda c, ps: "(" + " OR ".join(f"upper({c}) LIKE '{p.upper()}'" for p in ps) + ")"

_GROUPERS_SQL = """
attrs AS (SELECT c.plan_id, max(CASE WHEN s.type LIKE '%EPP11' THEN s.name END) AS submission_method, max(CASE WHEN s.type LIKE '%EPP12' THEN s.name END) AS billing_type,
   max(CASE WHEN s.type LIKE '%EPP13' THEN s.name END) AS lookback_rule, max(CASE WHEN s.type LIKE '%EPP14' THEN s.name END) AS start_rule,
   max(CASE WHEN s.type LIKE '%EPP15' THEN s.name END) AS end_rule, max(CASE WHEN s.type LIKE '%EPP16' THEN s.name END) AS date_rule
  FROM coverage c JOIN coverage_set s ON s.coverage_key = c.coverage_key AND c.is_benefit_plan = 1 GROUP BY c.plan_id),
plans AS (SELECT * FROM (SELECT c.plan_name, c.payor_name, a.*, row_number() OVER (PARTITION BY c.plan_name ORDER BY c.plan_id DESC, c.payor_name) AS rn
  FROM (SELECT DISTINCT plan_id, plan_name, payor_name FROM coverage) c JOIN attrs a ON a.plan_id = c.plan_id)
  WHERE rn = 1 AND billing_type IN ('ORMB INVOICE', 'ORMB INVOICE AND CLAIM'))"""


def _windows_sql(source: str, mid: int, extra: str = "") -> str:
    """Run date 1998-04-01 lies before the 15th."""
    return f"""
ended AS (SELECT *, CASE start_rule WHEN '15th of prior Month - 2' THEN DATE '1998-02-15' WHEN '1st of prior month-1' THEN DATE '1998-03-01'
    WHEN '1st of prior month-2' THEN DATE '1998-02-01' ELSE DATE '2099-01-01' END AS window_start,
  CASE end_rule WHEN 'Last day of prior month' THEN DATE '1998-03-31' WHEN '15th of prior month-1' THEN DATE '1998-03-15' ELSE DATE '2099-01-01' END AS window_end,
  CASE date_rule WHEN '1st of Month' THEN DATE '1998-05-01' WHEN '15th of month' THEN DATE '1998-04-15' ELSE DATE '2099-01-01' END AS next_billing FROM {source} {extra}),
windows AS (SELECT *, CAST(CASE
   WHEN lookback_rule = '1 Month' AND end_rule LIKE '%15%' THEN date_trunc('month', window_end) - INTERVAL 1 MONTH + INTERVAL {mid} DAY
   WHEN lookback_rule = '1 Month' THEN date_trunc('month', window_end)
   WHEN lookback_rule LIKE '%2 Months' AND end_rule LIKE '%15%' THEN date_trunc('month', window_end) - INTERVAL 2 MONTH + INTERVAL {mid} DAY
   WHEN lookback_rule LIKE '%2 Months' THEN date_trunc('month', window_end) - INTERVAL 2 MONTH
   WHEN lookback_rule = '45 Days' AND end_rule LIKE '%15%' THEN date_trunc('month', window_end) - INTERVAL 1 MONTH
   WHEN lookback_rule = '45 Days' THEN date_trunc('month', window_end) - INTERVAL 1 MONTH + INTERVAL {mid} DAY
   ELSE DATE '2099-01-01' END AS DATE) AS lookback_start FROM ended)"""


def _roster_sql(version: int) -> str:
    if version == 2:
        head = f"{_GROUPERS_SQL}, {_windows_sql('plans', 14, 'WHERE date_rule IS NOT NULL')}"
        people = """people AS (SELECT p.patient_key, m.coverage_key AS own_key, m.subscriber_number AS own_number, oc.plan_name AS own_plan,
   x.coverage_key AS ext_key, x.subscriber_number AS ext_number, coalesce(a.benefit_plan_key, m.coverage_key, x.coverage_key) AS plan_key,
   coalesce(a.health_plan_name, oc.plan_name, xc.plan_name) AS billed_plan
  FROM patient p LEFT JOIN (SELECT * FROM coverage_mapping WHERE effective_to >= DATE '1998-04-01') m ON m.patient_key = p.patient_key
  LEFT JOIN coverage oc ON oc.coverage_key = m.coverage_key LEFT JOIN external_coverage x ON x.patient_key = p.patient_key
  LEFT JOIN coverage xc ON xc.coverage_key = x.coverage_key LEFT JOIN member_attribute a ON a.patient_key = p.patient_key),
billed AS (SELECT people.*, w.lookback_start, w.window_end, w.billing_type FROM people JOIN windows w ON w.plan_name = people.billed_plan)"""
        visit_filter = f"""v.status IN ('Arrived', 'Completed') AND v.closed = 1 AND v.visit_key > 0 AND v.encounter_type <> 'Erroneous Encounter'
   AND NOT {_LIKE('b.own_plan', billing.EXCLUDED_PLANS)}"""
    else:
        head = """attrs AS (SELECT coverage_key, max(CASE WHEN type LIKE '%EPP12' THEN name END) AS billing_type, max(CASE WHEN type LIKE '%EPP13' THEN name END) AS lookback_rule,
   max(CASE WHEN type LIKE '%EPP14' THEN name END) AS start_rule, max(CASE WHEN type LIKE '%EPP15' THEN name END) AS end_rule,
   max(CASE WHEN type LIKE '%EPP16' THEN name END) AS date_rule FROM coverage_set GROUP BY coverage_key), """ + _windows_sql(
            "attrs", 15, "WHERE billing_type <> 'CLAIM'")
        people = """people AS (SELECT p.patient_key, m.subscriber_number AS own_number, x.subscriber_number AS ext_number,
   coalesce(x.coverage_key, m.coverage_key) AS plan_key FROM patient p LEFT JOIN coverage_mapping m ON m.patient_key = p.patient_key
   LEFT JOIN external_coverage x ON x.patient_key = p.patient_key),
billed AS (SELECT people.*, w.lookback_start, w.window_end, w.billing_type FROM people JOIN windows w ON w.coverage_key = people.plan_key)"""
        visit_filter = "v.status = 'Completed'"
    return f"""WITH {REVENUE_SQL}, {head}, {people},
seen AS (SELECT b.patient_key, max(v.visit_date) AS visit_date FROM billed b JOIN visit v ON v.patient_key = b.patient_key
  WHERE v.visit_date BETWEEN b.lookback_start AND b.window_end AND {visit_filter} GROUP BY b.patient_key),
base AS (SELECT p.mrn, p.name, p.first_name, p.middle_name, p.last_name, p.birth_date, p.state, p.city, p.county, p.postal_code, p.death_date, p.patient_id,
   p.primary_care_key, e.*, b.plan_key, b.window_end, b.own_number, b.ext_number, s.visit_date
  FROM episode e JOIN billed b ON b.patient_key = e.patient_key JOIN seen s ON s.patient_key = e.patient_key
  JOIN patient p ON p.patient_key = e.patient_key AND p.is_current = 1
  WHERE e.episode_key > 0 AND e.type = 'CH Palliative Care Program' AND e.enrollment_date <= b.window_end AND (e.end_date >= b.window_end OR e.end_date IS NULL)),
led AS (SELECT *, lead(enrollment_date) OVER w AS reinstated, lead(overall_status) OVER w AS next_status,
   lead(end_date) OVER (PARTITION BY mrn ORDER BY end_date NULLS FIRST, status_instant NULLS FIRST, episode_key) AS end_date_2,
   row_number() OVER w AS rn FROM base WINDOW w AS (PARTITION BY mrn ORDER BY enrollment_date, status_instant, episode_key)),
kept AS (SELECT * FROM led WHERE rn = 1 AND (end_date > window_end OR end_date IS NULL OR (end_date <= window_end AND reinstated >= end_date AND reinstated <= window_end
    AND (end_date_2 > window_end OR end_date_2 IS NULL))) AND (death_date > window_end OR death_date IS NULL))
SELECT 'D' AS record_type, k.name AS account_name, k.mrn AS contact_id, coalesce(k.own_number, k.ext_number) AS health_plan_patient_id, k.first_name, k.middle_name, k.last_name,
  CAST(k.birth_date AS VARCHAR) AS date_of_birth, CAST(k.enrollment_date AS VARCHAR) AS initial_active_date, CAST(k.end_date AS VARCHAR) AS discharge_date,
  coalesce(k.own_number, k.ext_number) AS primary_insurance_number, c.payor_name AS primary_insurance_name, c.plan_id AS ods_id, k.state AS market,
  'Home Base Palliative Care' AS program_enrolled, k.postal_code AS mailing_zip,
  CASE WHEN c.plan_name IS NULL THEN '' WHEN {_LIKE('c.plan_name', billing.MEDICAID_PLANS)} OR c.plan_name LIKE '%- CA%' THEN 'Anthem CA Medicaid' ELSE 'Anthem Medicaid' END
    || ' ' || coalesce(k.city, '') || ' ' || coalesce(c.financial_class, '') AS primary_contract,
  CASE WHEN k.reinstated IS NOT NULL THEN k.next_status ELSE k.overall_status END AS patient_status, CAST(k.reinstated AS VARCHAR) AS date_reinstated,
  CAST(k.visit_date AS VARCHAR) AS last_in_person_assessment, CAST(k.death_date AS VARCHAR) AS date_of_death, d.name AS primary_care_physician,
  k.state AS state_code, k.patient_id AS patient_sfid, k.county, k.ext_number AS member_key, CAST(k.visit_date AS VARCHAR) AS last_relevant_date,
  {", ".join(f"'' AS {b}" for b in billing.BLANKS)}
FROM kept k LEFT JOIN coverage c ON c.coverage_key = k.plan_key LEFT JOIN provider d ON d.provider_key = k.primary_care_key"""


@query("billing_roster", _roster_sql(2))
def billing_roster(t: Tables):
    return billing.billing_roster(revenue_tables(t), RUN_DATE)


@query("billing_roster_v1", _roster_sql(1))
def billing_roster_v1(t: Tables):
    return billing.billing_roster(revenue_tables(t), RUN_DATE, version=1)


@query("plan_windows", f"""WITH {REVENUE_SQL}, {_GROUPERS_SQL}, {_windows_sql('plans', 14, 'WHERE date_rule IS NOT NULL')}
SELECT plan_id, plan_name, billing_type, CAST(window_start AS VARCHAR) AS window_start, CAST(window_end AS VARCHAR) AS window_end,
  CAST(next_billing AS VARCHAR) AS next_billing, CAST(lookback_start AS VARCHAR) AS lookback_start FROM windows""")
def plan_windows(t: Tables):
    tables = revenue_tables(t)
    windows = billing.plan_windows(billing.plan_groupers(tables["coverage"], tables["coverage_set"]), RUN_DATE)
    return windows.select("plan_id", "plan_name", "billing_type", "window_start", "window_end", "next_billing", "lookback_start")


ACTIVE_SINCE = dt.date(1997, 12, 6)

_MEMBERS_SQL = f"""
members AS (SELECT DISTINCT coalesce(x.subscriber_number, CASE WHEN length(m.subscriber_number) > 1 THEN substr(m.subscriber_number, 4) END) AS subscriber_id,
   p.first_name, p.last_name, CASE WHEN e.tracking_status = 'Enrolled' THEN 'Y' ELSE 'N' END AS status, coalesce(mc.group_number, xc.group_number) AS group_id,
   e.type AS program_enrolled, xc.plan_name AS ext_plan, xc.payor_name AS ext_payor, mc.plan_name AS rte_plan, xc.product_type AS p1, mc.product_type AS p2,
   e.end_date, e.start_date, p.mrn
  FROM episode e JOIN patient p ON p.patient_key = e.patient_key AND p.is_current = 1 AND p.test = 0 AND p.status <> 'Deceased'
  LEFT JOIN coverage_mapping m ON m.patient_key = p.patient_key LEFT JOIN coverage mc ON mc.coverage_key = m.coverage_key
  LEFT JOIN external_coverage x ON x.patient_key = p.patient_key LEFT JOIN coverage xc ON xc.coverage_key = x.coverage_key
  WHERE (e.end_date >= DATE '1997-12-06' OR e.end_date IS NULL) AND e.enrollment_date IS NOT NULL AND e.type = 'CH Palliative Care Program'
   AND ({_LIKE('coalesce(xc.plan_name, mc.plan_name)', rosters.PLAN_PATTERNS)} OR {_LIKE('xc.payor_name', rosters.PAYOR_PATTERNS)})),
detail AS (SELECT subscriber_id, first_name, last_name, status, group_id, program_enrolled FROM members
  WHERE group_id <> '*Not Applicable' AND NOT regexp_matches(substr(group_id, 1, 2), '^[0-9]+$')
   AND group_id NOT IN ('{"', '".join(rosters.EXCLUDED_GROUPS)}') AND length(group_id) > 0),
total AS (SELECT count(*) AS n FROM detail)"""


@query("daily_roster", f"""WITH {REVENUE_SQL}, {_MEMBERS_SQL}
SELECT 1 AS record_order, 'HR' AS subscriber_id, '19980401' AS first_name, '' AS last_name, '' AS status, '' AS group_id, '' AS program_enrolled FROM total WHERE n > 0
UNION ALL SELECT 2, * FROM detail
UNION ALL SELECT 3, 'TR', '19980401', CAST(n AS VARCHAR), '', '', '' FROM total WHERE EXISTS (SELECT 1 FROM members)""")
def daily_roster(t: Tables):
    return rosters.daily_roster(revenue_tables(t), RUN_DATE, ACTIVE_SINCE)


@query("parent_company", f"""WITH {REVENUE_SQL},
parents AS (SELECT DISTINCT plan_name, parent_company FROM coverage WHERE parent_company <> '*Not Applicable')
SELECT DISTINCT p.patient_key, ec.plan_name AS ods_plan, ep.parent_company AS ods_parent, mc.plan_name AS rte_plan, mp.parent_company AS rte_parent,
  xc.plan_name AS hl7_plan, xp.parent_company AS hl7_parent
FROM episode e JOIN patient p ON p.patient_key = e.patient_key AND p.is_current = 1
LEFT JOIN eligibility g ON g.patient_key = p.patient_key LEFT JOIN coverage ec ON ec.coverage_key = g.coverage_key LEFT JOIN parents ep ON ep.plan_name = ec.plan_name
LEFT JOIN coverage_mapping m ON m.patient_key = p.patient_key AND m.effective_to >= DATE '1998-04-01' LEFT JOIN coverage mc ON mc.coverage_key = m.coverage_key
LEFT JOIN parents mp ON mp.plan_name = mc.plan_name
LEFT JOIN external_coverage x ON x.patient_key = p.patient_key LEFT JOIN coverage xc ON xc.coverage_key = x.coverage_key LEFT JOIN parents xp ON xp.plan_name = xc.plan_name""")
def parent_company(t: Tables):
    return rosters.parent_company(revenue_tables(t), RUN_DATE)


# ---------------------------------------------------------------- charges

STATES, SEXES, MARITAL, RELATIONS = ["AL", "CA", "FL", "GA", "NY"], ["F", "M", "U"], ["Single", "Married"], ["Self", "Spouse", "Child"]
_BIRTH = dt.date(1930, 1, 1)


def _codes(t: Tables, values, column):
    """Code list with as many rows as codes, one per nation key in use."""
    return t.nation.where(F.col("n_nationkey") < len(values)).select(
        F.col("n_nationkey").cast("long").alias("code"), choice(F.col("n_nationkey"), values).alias(column))


def charge_tables(t: Tables) -> dict:
    k = F.col("c_custkey")
    owner = t.orders.select("o_orderkey", F.col("o_custkey").alias("patient_id"))
    lines = t.lineitem.join(owner, F.col("l_orderkey") == F.col("o_orderkey"))
    person = t.customer.select(
        k.alias("patient_id"), F.col("c_mktsegment").alias("last_name"), F.substring("c_name", 1, 8).alias("first_name"),
        (k % 5).alias("state_code"), (k % 3).alias("sex_code"), (k % 2).alias("marital_code"),
        F.concat(F.lit("CITY "), F.col("c_nationkey").cast("string")).alias("city"), F.lpad((k % 99999).cast("string"), 5, "0").alias("zip"),
        F.date_add(F.lit(_BIRTH), (k * 37 % 25000).cast("int")).alias("birth_date"))
    account_name = F.when(F.col("c_mktsegment") == "FURNITURE", F.col("c_name")).otherwise(
        F.concat("c_mktsegment", F.lit(", "), F.substring("c_name", 1, 8), F.lit(" A")))
    guarantor = t.customer.select(
        k.alias("guarantor_id"), account_name.alias("account_name"), (k % 5).alias("state_code"),
        F.concat(F.lit("CITY "), F.col("c_nationkey").cast("string")).alias("city"), F.lpad((k % 99999).cast("string"), 5, "0").alias("zip"),
        F.date_add(F.lit(_BIRTH), (k * 37 % 25000).cast("int")).alias("birth_date"), F.col("c_nationkey").alias("employer_id"))

    def address(key):
        two = F.array(*[F.struct(F.lit(n).alias("line"), F.concat(F.lit(word), k.cast("string")).alias("address"))
                        for n, word in ((1, "STREET "), (2, "UNIT "))])
        return t.customer.select(k.alias(key), F.inline(two))
    sk = F.col("s_suppkey")
    return {
        "charge": lines.select(
            F.col("l_orderkey").alias("account_id"), "patient_id", F.col("patient_id").alias("guarantor_id"),
            F.col("l_linenumber").alias("charge_line"), F.col("l_partkey").alias("procedure_id"), F.col("l_quantity").alias("quantity"),
            F.col("l_shipdate").alias("filed_time"), F.col("l_shipdate").alias("service_date"), F.lit(1007).alias("destination"),
            F.when(F.col("l_linestatus") == "F", 1005).otherwise(1001).alias("source"),
            F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3).alias("system_flag"),
            F.when(F.col("l_returnflag") == "A", F.col("l_suppkey") + 1).alias("referring_id"), F.col("l_suppkey").alias("billing_id")),
        "account": t.orders.select(
            F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("patient_id"), F.col("o_orderdate").alias("admitted"),
            F.date_add(F.to_date("o_orderdate"), 3).alias("discharged"),
            F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(9).alias("class_code")),
        "coverage_list": lines.where("l_linenumber <= 3").groupBy(F.col("l_orderkey").alias("account_id"), F.col("l_linenumber").alias("line")).agg(
            F.min("l_suppkey").alias("coverage_id")),
        "coverage": t.supplier.select(
            sk.alias("coverage_id"), F.floor(sk / 2).alias("plan_id"), F.concat(F.lit("SUB"), sk.cast("string")).alias("subscriber_number"),
            choice(sk, ["G1", "G2", None]).alias("group_number"), F.col("s_name").alias("subscriber_name"),
            F.date_add(F.lit(_BIRTH), (sk % 9000).cast("int")).alias("subscriber_birth")),
        "plan": t.supplier.where(sk % 2 == 0).select(
            F.floor(sk / 2).alias("plan_id"), F.concat(F.lit("PLAN "), "s_name").alias("plan_name"), F.concat(F.lit("PO BOX "), sk.cast("string")).alias("plan_address"),
            F.lit(None).cast("string").alias("plan_address_2"), F.concat(F.lit("TOWN "), F.col("s_nationkey").cast("string")).alias("plan_city"),
            F.lpad(sk.cast("string"), 5, "0").alias("plan_zip"), (sk % 5).alias("plan_state_code")),
        "coverage_member": lines.groupBy(F.col("l_suppkey").alias("coverage_id"), "patient_id").agg(
            F.min(F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)).alias("relation_code"),
            F.max(F.when(F.col("l_linestatus") == "F", 0).otherwise(1)).alias("member_sex_code")),
        "patient": person, "guarantor": guarantor, "patient_address": address("patient_id"), "guarantor_address": address("guarantor_id"),
        "employer": t.nation.select(F.col("n_nationkey").alias("employer_id"), F.col("n_name").alias("employer_name"),
                                    (F.col("n_nationkey") % 5).cast("long").alias("state_code")),
        "provider": t.supplier.select(sk.alias("provider_id"), F.col("s_name").alias("name")),
        "state": _codes(t, STATES, "abbr"), "sex": _codes(t, SEXES, "abbr"), "marital": _codes(t, MARITAL, "name"),
        "relation": _codes(t, RELATIONS, "name"),
    }


def _insurance_sql(n: int, p: str) -> str:
    a = f"i{n}"
    return f"""CAST({a}.plan_id AS BIGINT) AS {p}_plan_code, {a}.plan_name AS {p}_name, {a}.plan_address AS {p}_address, CAST(NULL AS VARCHAR) AS {p}_address_2, {a}.plan_city AS {p}_city,
  {a}.plan_state AS {p}_state, {a}.plan_zip AS {p}_zip, {a}.subscriber_number AS {p}_policy_number, {a}.group_number AS {p}_group_number, {a}.subscriber_name AS {p}_insured_name,
  CAST({a}.subscriber_birth AS VARCHAR) AS {p}_insured_dob, {a}.relation AS {p}_insured_relationship, {a}.sex AS {p}_insured_gender"""


_CHARGE_SQL = f"""WITH lines AS (SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderstatus FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
member AS (SELECT l_suppkey, o_custkey, CASE min(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) WHEN 0 THEN 'Self' WHEN 1 THEN 'Spouse' ELSE 'Child' END AS relation,
   CASE max(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END) WHEN 0 THEN 'F' ELSE 'M' END AS sex FROM lines GROUP BY ALL),
listed AS (SELECT l_orderkey, l_linenumber, o_custkey, min(l_suppkey) AS k FROM lines WHERE l_linenumber <= 3 GROUP BY ALL),
ins AS (SELECT g.l_orderkey, g.l_linenumber, p.s_suppkey // 2 AS plan_id, 'PLAN ' || p.s_name AS plan_name, 'PO BOX ' || CAST(p.s_suppkey AS VARCHAR) AS plan_address,
   'TOWN ' || CAST(p.s_nationkey AS VARCHAR) AS plan_city, {sql_choice('p.s_suppkey', STATES)} AS plan_state, lpad(CAST(p.s_suppkey AS VARCHAR), 5, '0') AS plan_zip,
   'SUB' || CAST(s.s_suppkey AS VARCHAR) AS subscriber_number, {sql_choice('s.s_suppkey', ['G1', 'G2', None])} AS group_number, s.s_name AS subscriber_name,
   DATE '1930-01-01' + CAST(s.s_suppkey % 9000 AS INTEGER) AS subscriber_birth, m.relation, m.sex
  FROM listed g JOIN supplier s ON s.s_suppkey = g.k JOIN supplier p ON p.s_suppkey = (s.s_suppkey // 2) * 2
  LEFT JOIN member m ON m.l_suppkey = g.k AND m.o_custkey = g.o_custkey)
SELECT l.l_orderkey AS account_id, l.o_custkey AS patient_id, l.o_custkey AS guarantor_id, l.l_linenumber AS charge_line, l.l_partkey AS procedure_id, l.l_quantity AS quantity,
  r.s_name AS referring_doctor, CAST(CAST(l.o_orderdate AS DATE) AS VARCHAR) AS visit_admission_date, CAST(CAST(l.o_orderdate AS DATE) + 3 AS VARCHAR) AS visit_discharge_date,
  CASE l.o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'O' END AS visit_type, {_insurance_sql(1, 'primary')}, {_insurance_sql(2, 'secondary')}, {_insurance_sql(3, 'tertiary')},
  c.c_mktsegment AS patient_last_name, substr(c.c_name, 1, 8) AS patient_first_name, 'STREET ' || CAST(c.c_custkey AS VARCHAR) AS patient_address,
  'UNIT ' || CAST(c.c_custkey AS VARCHAR) AS patient_address_2, 'CITY ' || CAST(c.c_nationkey AS VARCHAR) AS patient_city, {sql_choice('c.c_custkey', STATES)} AS patient_state,
  lpad(CAST(c.c_custkey % 99999 AS VARCHAR), 5, '0') AS patient_zip, CAST(DATE '1930-01-01' + CAST(c.c_custkey * 37 % 25000 AS INTEGER) AS VARCHAR) AS patient_dob,
  {sql_choice('c.c_custkey', SEXES)} AS patient_gender, {sql_choice('c.c_custkey', MARITAL)} AS patient_marital_status,
  CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN c.c_mktsegment END AS responsible_last_name,
  CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN substr(c.c_name, 1, 8) END AS responsible_first_name,
  'STREET ' || CAST(c.c_custkey AS VARCHAR) AS responsible_address, 'UNIT ' || CAST(c.c_custkey AS VARCHAR) AS responsible_address_2,
  'CITY ' || CAST(c.c_nationkey AS VARCHAR) AS responsible_city, {sql_choice('c.c_custkey', STATES)} AS responsible_state,
  lpad(CAST(c.c_custkey % 99999 AS VARCHAR), 5, '0') AS responsible_zip, CAST(DATE '1930-01-01' + CAST(c.c_custkey * 37 % 25000 AS INTEGER) AS VARCHAR) AS responsible_dob,
  n.n_name AS employer_name, {sql_choice('n.n_nationkey', STATES)} AS employer_state, CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS visit_date_of_service
FROM lines l JOIN customer c ON c.c_custkey = l.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN supplier r ON r.s_suppkey = CASE WHEN l.l_returnflag = 'A' THEN l.l_suppkey + 1 ELSE l.l_suppkey END
LEFT JOIN ins i1 ON i1.l_orderkey = l.l_orderkey AND i1.l_linenumber = 1 LEFT JOIN ins i2 ON i2.l_orderkey = l.l_orderkey AND i2.l_linenumber = 2
LEFT JOIN ins i3 ON i3.l_orderkey = l.l_orderkey AND i3.l_linenumber = 3
WHERE l.l_linestatus = 'F' AND l.l_returnflag IN ('A', 'R')"""


@query("charge_extract", _CHARGE_SQL)
def charge_extract(t: Tables):
    return charges.charge_extract(charge_tables(t), RUN_DATE, None, [1007], [1005], [1, 3])


@query("charge_extract_filed", _CHARGE_SQL + " AND date_diff('day', l.l_shipdate, DATE '1998-04-01') = 3")
def charge_extract_filed(t: Tables):
    """The report's own filing window: exactly three days before the run."""
    return charges.charge_extract(charge_tables(t), RUN_DATE, 3, [1007], [1005], [1, 3])


# ---------------------------------------------------------------- per-payer reports

def stays(t: Tables):
    who = patient(t).select("patient_key", "mrn", "name", "birth_date")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(who, F.col("o_custkey") == F.col("patient_key"))
    day = F.to_date("o_orderdate")
    return rows.select(
        F.col("n_nationkey").alias("location_id"), F.col("c_mktsegment").alias("payer"), F.col("o_orderpriority").alias("plan"),
        F.col("o_orderkey").alias("hospital_account"), "mrn", F.col("name").alias("patient_name"), F.col("birth_date").alias("dob"),
        F.concat(F.lit("SUB"), F.col("o_custkey").cast("string")).alias("subscriber_number"), day.alias("admission_date"),
        F.date_add(day, 4).alias("discharge_date"), F.lit("DX").alias("primary_diagnosis"), F.lit("DR").alias("admitting_provider"),
        F.col("o_orderstatus").alias("patient_class"), F.concat(F.lit("U"), F.col("n_nationkey").cast("string")).alias("unit"),
        F.lit("R1").alias("room_name"), F.lit(None).cast("string").alias("authorization_number"), F.lit("Home").alias("discharge_disposition"),
        F.lit(4).alias("los"), F.lit("MED").alias("hospital_service"))


def report_drivers(t: Tables, active_only: bool):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    listed = rows.select(
        F.col("c_mktsegment").alias("payer"), F.col("n_name").alias("facility"), F.col("n_nationkey").alias("location_id"),
        F.concat(F.lit("555-"), F.col("n_nationkey").cast("string")).alias("fax"), F.col("o_orderpriority").alias("plan"),
        F.when(F.col("n_regionkey") == 0, 0).otherwise(1).alias("active")).where("plan <> '5-LOW'")
    return payer_reports.drivers(listed, active_only)


_STAYS_SQL = """stays AS (SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS day, o.o_orderstatus, o.o_orderpriority AS plan, c.c_mktsegment AS payer, c.c_name,
  n.n_nationkey, n.n_name AS facility, n.n_regionkey FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey)"""
_STAY_COLUMNS = """payer, facility, plan, '''' || CAST(o_orderkey AS VARCHAR) AS hospital_account, payer || ', ' || substr(c_name, 1, 8) AS patient_name,
  CAST(DATE '1930-01-01' + CAST(o_custkey * 37 % 25000 AS INTEGER) AS VARCHAR) AS dob, 'SUB' || CAST(o_custkey AS VARCHAR) AS subscriber_number, CAST(day AS VARCHAR) AS admit_date,
  o_orderstatus AS patient_class"""


@query("payer_location_report", f"""WITH {_STAYS_SQL}
SELECT payer, facility, n_nationkey AS location_id, '555-' || CAST(n_nationkey AS VARCHAR) AS fax, plan, count(*) AS n_rows FROM stays WHERE plan <> '5-LOW' GROUP BY ALL""")
def payer_location_report(t: Tables):
    return payer_reports.report_counts(stays(t), report_drivers(t, False))


@query("census_report", f"""WITH {_STAYS_SQL}
SELECT 'Census_' || payer || '_' || facility || '_' || replace(plan, ' ', '') || '_19980401.csv' AS file_name, {_STAY_COLUMNS}, 'DX' AS primary_dx, 'DR' AS admit_provider,
  'U' || CAST(n_nationkey AS VARCHAR) AS unit, 'R1' AS room_name FROM stays WHERE plan <> '5-LOW'""")
def census_report(t: Tables):
    return payer_reports.report_rows(stays(t), report_drivers(t, False), payer_reports.CENSUS,
                                     "Census_<FILENAMEPART>_YYYYMMDD.csv", F.lit(RUN_DATE))


@query("discharge_report", f"""WITH {_STAYS_SQL}
SELECT 'Discharge_' || payer || '_' || facility || '_' || replace(plan, ' ', '') || '_19980401.csv' AS file_name, {_STAY_COLUMNS},
  'M' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS mrn, CAST(NULL AS VARCHAR) AS authorization_number, CAST(day + 4 AS VARCHAR) AS discharge_date,
  'Home' AS disposition, 4 AS los, 'MED' AS service FROM stays WHERE plan <> '5-LOW' AND n_regionkey <> 0""")
def discharge_report(t: Tables):
    return payer_reports.report_rows(stays(t), report_drivers(t, True), payer_reports.DISCHARGE,
                                     "Discharge_<FILENAMEPART>_YYYYMMDD.csv", F.lit(RUN_DATE))
