"""Daily payer roster and parent-company resolution."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import active_on, current_rows
from ..functions.text import drop_first, like_any, tsql_isnumeric, tsql_len
from ..operators.aggregates import header_detail_trailer
from ..session import materialise
from .billing import PROGRAM

# Plans of the daily roster.
ADVANTAGE_PLANS = ["ANTHEM BLUE CROSS MEDICARE ADVANTAGE", "ANTHEM BLUE CROSS AND BLUE SHIELD MEDICARE ADVANTAGE"]
OTHER_PLANS = ["Anthem GRS", "MMP", "WellPoint Medicare Advantage", "HEALTHY BLUE MEDICARE ADVANTAGE", "Wellpoint GRS",
               "SIMPLY HEALTHCARE", "WELLPOINT MEDICAID"]
MEDICAID_PLANS = ["MEDICAID - FL", "MEDICAID - WI", "MEDICAID - WA", "MEDICAID - VA", "MEDICAID - TX", "MEDICAID - TN", "MEDICAID - NY", "MEDICAID - NV",
                  "MEDICAID - NJ", "MEDICAID - MO", "MEDICAID - MD", "MEDICAID - LA", "MEDICAID - IN", "MEDICAID - IA", "MEDICAID - GA"]
ANYWHERE = [f"%{p}%" for p in OTHER_PLANS + MEDICAID_PLANS]
PLAN_PATTERNS = [f"%{p}%" for p in ADVANTAGE_PLANS] + ANYWHERE
PAYOR_PATTERNS = [f"{p}%" for p in ADVANTAGE_PLANS] + ANYWHERE      # these two only at the start of a payor name
# Group ids left out of the roster.
EXCLUDED_GROUPS = ["KYPDPWP0", "CF030000", "NYSUPWP0", "MOPDPWP0", "H510KYH00001KY013002", "GA6306M030", "OHPDPWP0", "TXMMP000"]

ROSTER_COLUMNS = ["subscriber_id", "first_name", "last_name", "status", "group_id", "program_enrolled"]


def roster_members(tables: Mapping[str, DataFrame], active_since: dt.date, ignore_case: bool = True) -> DataFrame:
    """Distinct members enrolled in the program under one of the listed plans."""
    patient = current_rows(tables["patient"], test="test", status="status").select(
        "patient_key", "mrn", "first_name", "last_name")
    episodes = tables["episode"].where(
        active_on("end_date", active_since) & F.col("enrollment_date").isNotNull() & (F.col("type") == PROGRAM))
    cov = tables["coverage"]

    def source(name, prefix):
        own = tables[name].select(
            "patient_key", F.col("coverage_key").alias(f"{prefix}_key"), F.col("subscriber_number").alias(f"{prefix}_number"))
        named = cov.select(
            F.col("coverage_key").alias(f"{prefix}_key"), F.col("plan_name").alias(f"{prefix}_plan"),
            F.col("payor_name").alias(f"{prefix}_payor"), F.col("group_number").alias(f"{prefix}_group"),
            F.col("product_type").alias(f"{prefix}_product"))
        return own.join(named, f"{prefix}_key", "left").distinct()

    joined = (
        episodes.select("patient_key", "type", "tracking_status", "end_date", "start_date").distinct()
        .join(patient, "patient_key")
        .join(source("coverage_mapping", "rte"), "patient_key", "left")
        .join(source("external_coverage", "ext"), "patient_key", "left")
    )
    listed = F.coalesce(like_any(F.coalesce("ext_plan", "rte_plan"), PLAN_PATTERNS, ignore_case), F.lit(False)) | F.coalesce(
        like_any("ext_payor", PAYOR_PATTERNS, ignore_case), F.lit(False))
    own_id = F.when(tsql_len("rte_number") > 1, drop_first("rte_number", 3))
    return joined.where(listed).select(
        F.coalesce("ext_number", own_id).alias("subscriber_id"), "first_name", "last_name",
        F.when(F.col("tracking_status") == "Enrolled", "Y").otherwise("N").alias("status"),
        F.coalesce("rte_group", "ext_group").alias("group_id"), F.col("type").alias("program_enrolled"),
        "ext_plan", "ext_payor", "rte_plan", "ext_product", "rte_product", "end_date", "start_date", "mrn").distinct()


def billable_group(group: str):
    g = F.col(group)
    return ((g != "*Not Applicable") & (tsql_isnumeric(F.substring(g, 1, 2)) != 1) & ~g.isin(EXCLUDED_GROUPS)
            & (tsql_len(g) > 0))


def daily_roster(tables: Mapping[str, DataFrame], run_date: dt.date, active_since: dt.date, ignore_case: bool = True) -> DataFrame:
    """Header, detail and trailer records.  The trailer follows any matched member, the header needs detail rows."""
    members = roster_members(tables, active_since, ignore_case)
    # Header, detail and trailer read the members several times: stage them once.
    members = materialise(members.sparkSession, members, "roster-members")
    detail = members.where(billable_group("group_id")).select(*ROSTER_COLUMNS)
    return header_detail_trailer(detail, members, run_date.strftime("%Y%m%d"), ROSTER_COLUMNS)


def plan_parents(coverage: DataFrame) -> DataFrame:
    return coverage.where(F.col("parent_company") != "*Not Applicable").select("plan_name", "parent_company").distinct()


def parent_company(tables: Mapping[str, DataFrame], run_date: dt.date, patients: DataFrame | None = None) -> DataFrame:
    """Plan and parent company of a patient from eligibility, real-time and external coverage.

    Each source is reduced to its distinct plans per patient before they meet, and patients are distinct, so the joined rows
    are distinct as they come.  ``patients`` (patient_key) limits the report.
    """
    cov, parents = tables["coverage"], plan_parents(tables["coverage"])

    def source(df, plan, parent):
        named = df.join(cov.select("coverage_key", "plan_name"), "coverage_key", "left").join(parents, "plan_name", "left")
        return named.select("patient_key", F.col("plan_name").alias(plan), F.col("parent_company").alias(parent)).distinct()

    live = tables["coverage_mapping"].where(F.col("effective_to") >= F.lit(run_date))
    people = tables["episode"].select("patient_key").distinct().join(
        current_rows(tables["patient"]).select("patient_key"), "patient_key", "left_semi")
    if patients is not None:
        people = people.join(patients.select("patient_key").distinct(), "patient_key", "left_semi")
    return (
        people.join(source(tables["eligibility"], "ods_plan", "ods_parent"), "patient_key", "left")
        .join(source(live, "rte_plan", "rte_parent"), "patient_key", "left")
        .join(source(tables["external_coverage"], "hl7_plan", "hl7_parent"), "patient_key", "left")
    )
