"""Warehouse-shaped frames made from the driver tables, with the same frames as SQL for the oracle."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import materialise
from . import LazyTables, Tables
from .basics import COVERAGE_SLOTS_SQL, coverage_slots


def choice(number: Column, values: list) -> Column:
    """A value by remainder of ``number``."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (number % len(values)).cast("int") + 1)


def sql_choice(number: str, values: list) -> str:
    items = ", ".join("NULL" if v is None else "'" + v + "'" for v in values)
    return f"([{items}])[CAST(({number}) % {len(values)} AS INTEGER) + 1]"


PLAN_NAMES = ["ANTHEM BLUE CROSS MEDICAID - CA", "WELLPOINT MEDICAID - TX", "AMERIGROUP COMMERCIAL", "ANTHEM COMMERCIAL ASO",
              "ANTHEM BLUE CROSS MEDICARE ADVANTAGE", "SIMPLY HEALTHCARE", "OTHER PLAN", "MEDICAID - FL", "Anthem GRS",
              "HEALTHY BLUE MEDICARE ADVANTAGE", "BCBS AL MEDICARE ADVANTAGE", None, "LOCAL HMO"]
PAYORS = ["ANTHEM BLUE CROSS MEDICARE ADVANTAGE PAYOR", "MMP PAYOR", None, "OTHER PAYOR", "WELLPOINT MEDICAID PAYOR"]
CLASSES = ["Medicaid", "Medicare Replacement", None]
GROUP_IDS = ["KYPDPWP0", "GRP1", "12AB", "*Not Applicable", "", None, "HMO7"]
PARENTS = ["PARENT A", "PARENT B", "*Not Applicable", "PARENT C"]
PRODUCTS = ["HMO", "PPO", None]
SETS = {
    "Epic Benefit Plan Report Grouper EPP11": ["FAX", "EDI"],
    "Epic Benefit Plan Report Grouper EPP12": ["ORMB INVOICE", "ORMB INVOICE AND CLAIM", "CLAIM"],
    "Epic Benefit Plan Report Grouper EPP13": ["1 Month", "2 Months", "45 Days", "Modified 2 Months"],
    "Epic Benefit Plan Report Grouper EPP14": ["15th of prior Month - 2", "1st of prior month-1", "1st of prior month-2"],
    "Epic Benefit Plan Report Grouper EPP15": ["Last day of prior month", "15th of prior month-1"],
    "Epic Benefit Plan Report Grouper EPP16": ["1st of Month", "15th of month", "1st of Month", None, "15th of month"],
}


def coverage(t: Tables):
    k = F.col("s_suppkey")
    plan = F.floor(k / 2)
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        k.alias("coverage_key"), plan.alias("plan_id"), F.concat(choice(plan, PLAN_NAMES), F.lit(" "), "n_name").alias("plan_name"),
        choice(plan, PAYORS).alias("payor_name"), choice(plan, CLASSES).alias("financial_class"),
        choice(k, GROUP_IDS).alias("group_number"), choice(plan, PARENTS).alias("parent_company"),
        choice(plan, PRODUCTS).alias("product_type"), F.when(k % 2 == 0, 1).otherwise(0).alias("is_benefit_plan"))


def coverage_set(t: Tables):
    plan = F.floor(F.col("s_suppkey") / 2)
    rows = F.array(*[F.struct(F.lit(kind).alias("type"), choice(plan, names).alias("name")) for kind, names in SETS.items()])
    return t.supplier.select(F.col("s_suppkey").alias("coverage_key"), F.inline(rows))


def patient(t: Tables):
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    return t.customer.select(
        k.alias("patient_key"), F.when(bal < 300, 0).otherwise(1).alias("is_current"),
        F.when(F.col("c_nationkey") == 24, 0).otherwise(1).alias("is_valid"), F.when(bal > 9900, 1).otherwise(0).alias("test"),
        F.when(bal.between(300, 600), "Deceased").otherwise("Alive").alias("status"),
        F.concat(F.lit("M"), F.lpad(k.cast("string"), 9, "0")).alias("mrn"), F.concat(F.lit("E"), k.cast("string")).alias("patient_id"),
        F.concat("c_mktsegment", F.lit(", "), F.substring("c_name", 1, 8)).alias("name"),
        F.substring("c_name", 1, 8).alias("first_name"), choice(k, ["Q", None]).alias("middle_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.date_add(F.lit(dt.date(1930, 1, 1)), (k * 37 % 25000).cast("int")).alias("birth_date"),
        F.when(bal.between(600, 900), F.lit(dt.date(1998, 2, 10))).alias("death_date"), choice(k, ["Female", "Male", "Unknown"]).alias("sex"),
        choice(k, ["White", "Black", "Asian", None]).alias("race"), choice(k, ["Not Hispanic", "Hispanic"]).alias("ethnicity"),
        F.concat(F.lit("CITY "), choice(F.col("c_nationkey"), ["A", "B", None])).alias("city"),
        F.concat(F.lit("COUNTY "), F.col("c_nationkey").cast("string")).alias("county"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state"),
        F.lpad((k % 99999).cast("string"), 5, "0").alias("postal_code"), (k % 97).alias("primary_care_key"), (k % 90).alias("age_in_years"),
        choice(k, ["Former", "Never", "Every Day", None]).alias("smoking_status"))


def provider(t: Tables):
    return t.supplier.select(F.col("s_suppkey").alias("provider_key"), F.col("s_name").alias("name"))


def _slots(t: Tables):
    """Coverage slots with their customer, staged once per run because three sources come from it."""
    if "staged_slots" not in t.__dict__:
        joined = coverage_slots(t).join(t.customer, F.col("patient_key") == F.col("c_custkey"))
        t.staged_slots = materialise(t.spark, joined, "slots")
    return t.staged_slots


def member_attribute(t: Tables):
    names = coverage(t).select(F.col("coverage_key").alias("third_key"), "plan_name")
    return _slots(t).where("c_mktsegment = 'HOUSEHOLD' and third_key is not null").join(names, "third_key").select(
        "patient_key", F.col("plan_name").alias("health_plan_name"), F.col("third_key").alias("benefit_plan_key"))


def coverage_mapping(t: Tables):
    k = F.col("patient_key")
    return _slots(t).where("c_acctbal < 8000 and first_key is not null").select(
        "patient_key", F.col("first_key").alias("coverage_key"),
        F.when(F.col("c_nationkey") == 3, "A").otherwise(F.concat(F.lit("PRE"), k.cast("string"))).alias("subscriber_number"),
        F.when(F.col("c_nationkey") == 5, F.lit(dt.date(1997, 1, 1))).otherwise(F.lit(dt.date(2001, 12, 31))).alias("effective_to"))


def external_coverage(t: Tables):
    return _slots(t).where("c_mktsegment <> 'MACHINERY' and second_key is not null").select(
        "patient_key", F.col("second_key").alias("coverage_key"),
        F.when(F.col("c_nationkey") != 4, F.concat(F.lit("X"), F.col("patient_key").cast("string"))).alias("subscriber_number"))


def eligibility(t: Tables):
    """Every plan seen on a patient's lines."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).where("l_returnflag = 'R' and l_linestatus = 'F'")
    return lines.select(F.col("o_custkey").alias("patient_key"), F.col("l_suppkey").alias("coverage_key"))


def visit(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").alias("visit_key"), F.col("o_custkey").alias("patient_key"), F.col("o_orderdate").alias("appointment_date"),
        F.when(F.col("o_orderstatus") == "F", "Completed").when(F.col("o_orderstatus") == "O", "Arrived").otherwise("Canceled").alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1).alias("closed"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Erroneous Encounter").otherwise("Office Visit").alias("encounter_type"))


def episode(t: Tables):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        F.col("o_orderkey").alias("episode_key"), F.col("o_custkey").alias("patient_key"),
        F.when(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), "Other Program").otherwise("CH Palliative Care Program").alias("type"),
        F.date_sub(day, 200).alias("enrollment_date"), F.date_sub(day, 190).alias("start_date"),
        F.when(F.col("o_orderstatus") != "P", F.date_add(day, 20)).alias("end_date"),
        F.when(F.col("o_orderstatus") == "P", "Active").otherwise("Closed").alias("overall_status"),
        F.when(F.col("o_orderstatus") == "F", "Graduated").otherwise("Enrolled").alias("tracking_status"),
        F.date_add(day, 1).alias("status_instant"))


def revenue_tables(t: Tables) -> LazyTables:
    return LazyTables({f.__name__: partial(f, t) for f in (coverage, coverage_set, patient, provider, member_attribute, coverage_mapping,
                                       external_coverage, eligibility, visit, episode)})


_SET_ROWS = " UNION ALL ".join(
    f"SELECT s_suppkey AS coverage_key, '{kind}' AS type, {sql_choice('s_suppkey // 2', names)} AS name FROM supplier"
    for kind, names in SETS.items())

REVENUE_SQL = f"""{COVERAGE_SLOTS_SQL},
coverage AS (SELECT s_suppkey AS coverage_key, s_suppkey // 2 AS plan_id, {sql_choice('s_suppkey // 2', PLAN_NAMES)} || ' ' || n_name AS plan_name,
  {sql_choice('s_suppkey // 2', PAYORS)} AS payor_name, {sql_choice('s_suppkey // 2', CLASSES)} AS financial_class,
  {sql_choice('s_suppkey', GROUP_IDS)} AS group_number, {sql_choice('s_suppkey // 2', PARENTS)} AS parent_company,
  {sql_choice('s_suppkey // 2', PRODUCTS)} AS product_type, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END AS is_benefit_plan
  FROM supplier JOIN nation ON n_nationkey = s_nationkey),
coverage_set AS ({_SET_ROWS}),
patient AS (SELECT c_custkey AS patient_key, CASE WHEN c_acctbal < 300 THEN 0 ELSE 1 END AS is_current, CASE WHEN c_nationkey = 24 THEN 0 ELSE 1 END AS is_valid,
  CASE WHEN c_acctbal > 9900 THEN 1 ELSE 0 END AS test, CASE WHEN c_acctbal BETWEEN 300 AND 600 THEN 'Deceased' ELSE 'Alive' END AS status,
  'M' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mrn, 'E' || CAST(c_custkey AS VARCHAR) AS patient_id,
  c_mktsegment || ', ' || substr(c_name, 1, 8) AS name, substr(c_name, 1, 8) AS first_name, {sql_choice('c_custkey', ['Q', None])} AS middle_name,
  c_mktsegment AS last_name, DATE '1930-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) AS birth_date,
  CASE WHEN c_acctbal BETWEEN 600 AND 900 THEN DATE '1998-02-10' END AS death_date, {sql_choice('c_custkey', ['Female', 'Male', 'Unknown'])} AS sex,
  {sql_choice('c_custkey', ['White', 'Black', 'Asian', None])} AS race, {sql_choice('c_custkey', ['Not Hispanic', 'Hispanic'])} AS ethnicity,
  'CITY ' || {sql_choice('c_nationkey', ['A', 'B', None])} AS city, 'COUNTY ' || CAST(c_nationkey AS VARCHAR) AS county,
  'S' || CAST(c_nationkey AS VARCHAR) AS state, lpad(CAST(c_custkey % 99999 AS VARCHAR), 5, '0') AS postal_code, c_custkey % 97 AS primary_care_key, c_custkey % 90 AS age_in_years,
  {sql_choice('c_custkey', ['Former', 'Never', 'Every Day', None])} AS smoking_status FROM customer),
provider AS (SELECT s_suppkey AS provider_key, s_name AS name FROM supplier),
slots AS (SELECT * FROM coverage_slots JOIN customer ON c_custkey = patient_key),
member_attribute AS (SELECT patient_key, plan_name AS health_plan_name, third_key AS benefit_plan_key FROM slots JOIN coverage ON coverage_key = third_key
  WHERE c_mktsegment = 'HOUSEHOLD'),
coverage_mapping AS (SELECT patient_key, first_key AS coverage_key, CASE WHEN c_nationkey = 3 THEN 'A' ELSE 'PRE' || CAST(patient_key AS VARCHAR) END AS subscriber_number,
  CASE WHEN c_nationkey = 5 THEN DATE '1997-01-01' ELSE DATE '2001-12-31' END AS effective_to FROM slots WHERE c_acctbal < 8000 AND first_key IS NOT NULL),
external_coverage AS (SELECT patient_key, second_key AS coverage_key, CASE WHEN c_nationkey <> 4 THEN 'X' || CAST(patient_key AS VARCHAR) END AS subscriber_number
  FROM slots WHERE c_mktsegment <> 'MACHINERY' AND second_key IS NOT NULL),
eligibility AS (SELECT o_custkey AS patient_key, l_suppkey AS coverage_key FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_linestatus = 'F'),
visit AS (SELECT o_orderkey AS visit_key, o_custkey AS patient_key, CAST(o_orderdate AS DATE) AS visit_date,
  CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Arrived' ELSE 'Canceled' END AS status, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS closed,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Erroneous Encounter' ELSE 'Office Visit' END AS encounter_type FROM orders),
episode AS (SELECT o_orderkey AS episode_key, o_custkey AS patient_key,
  CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Other Program' ELSE 'CH Palliative Care Program' END AS type,
  CAST(o_orderdate AS DATE) - 200 AS enrollment_date, CAST(o_orderdate AS DATE) - 190 AS start_date,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 20 END AS end_date, CASE WHEN o_orderstatus = 'P' THEN 'Active' ELSE 'Closed' END AS overall_status,
  CASE WHEN o_orderstatus = 'F' THEN 'Graduated' ELSE 'Enrolled' END AS tracking_status, CAST(o_orderdate AS DATE) + 1 AS status_instant FROM orders)"""
