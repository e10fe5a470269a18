"""Monthly billing eligibility roster."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import NO_WINDOW, col, month_grid, month_start
from ..functions.keys import current_rows, real_key
from ..functions.text import concat_tsql, like_any, not_like_all
from ..operators.aggregates import eav_pivot
from ..operators.picks import first_per, next_row
from ..session import materialise

# Grouper type -> plan attribute.
GROUPERS = {
    "Epic Benefit Plan Report Grouper EPP11": "submission_method",
    "Epic Benefit Plan Report Grouper EPP12": "billing_type",
    "Epic Benefit Plan Report Grouper EPP13": "lookback_rule",
    "Epic Benefit Plan Report Grouper EPP14": "start_rule",
    "Epic Benefit Plan Report Grouper EPP15": "end_rule",
    "Epic Benefit Plan Report Grouper EPP16": "date_rule",
}
# Billing types, program, visit states and the plans left out of billing.
INVOICE_TYPES = ["ORMB INVOICE", "ORMB INVOICE AND CLAIM"]
PROGRAM = "CH Palliative Care Program"
PROGRAM_LABEL = "Home Base Palliative Care"
VISIT_DONE = ["Arrived", "Completed"]
VISIT_DONE_V1 = ["Completed"]
BAD_ENCOUNTER = "Erroneous Encounter"
EXCLUDED_PLANS = ["%ANTHEM%COMMERCIAL%ASO%", "%WELLPOINT%COMMERCIAL%ASO%", "%AMERIGROUP%COMMERCIAL%ASO%",
                  "%BCBS AL MEDICARE ADVANTAGE%"]
MEDICAID_PLANS = ["%ANTHEM%MEDICAID%", "%WELLPOINT%MEDICAID%", "%AMERIGROUP%MEDICAID%"]
COMMERCIAL_PLANS = ["%ANTHEM%COMMERCIAL%", "%WELLPOINT%COMMERCIAL%", "%AMERIGROUP%COMMERCIAL%"]
MEDICARE_PLANS = ["%ANTHEM%", "%WELLPOINT%", "AMERIGROUP%", "%SIMPLY HEALTH%"]
CALIFORNIA = "%- CA%"


def _mid_by_half(grid, early: str, late: str) -> Column:
    return F.when(grid["before15"] == 1, grid[early]).otherwise(grid[late])


def window_start(rule, grid) -> Column:
    r, none = col(rule), F.lit(NO_WINDOW)
    return (
        F.when(r == "15th of prior Month - 2", _mid_by_half(grid, "m2_mid", "m1_mid"))
        .when(r == "1st of prior month-1", grid["m1_begin"])
        .when(r == "1st of prior month-2", grid["m2_begin"])
        .otherwise(none)
    )


def window_end(rule, grid) -> Column:
    r = col(rule)
    return (
        F.when(r == "Last day of prior month", grid["m1_end"])
        .when(r == "15th of prior month-1", _mid_by_half(grid, "m1_mid", "m0_mid"))
        .otherwise(F.lit(NO_WINDOW))
    )


def next_billing(rule, grid) -> Column:
    r = col(rule)
    return (
        F.when(r == "1st of Month", grid["p1_begin"])
        .when(r == "15th of month", _mid_by_half(grid, "m0_mid", "p1_mid"))
        .otherwise(F.lit(NO_WINDOW))
    )


# Look-back rule -> (months back, mid-month) for a window ending mid-month, and otherwise.
LOOKBACK = {
    "1 Month": ((1, True), (0, False)),
    "2 Months": ((2, True), (2, False)),
    "45 Days": ((1, False), (1, True)),
    "Modified 2 Months": ((2, True), (2, False)),
}


def lookback_start(rule, end_rule, end, version: int = 2) -> Column:
    """First day of the look-back window; version 1 lies one day later on the mid-month starts."""
    mid = 14 if version == 2 else 15
    at_mid = F.coalesce(col(end_rule).like("%15%"), F.lit(False))
    out = None
    for name, (when_mid, otherwise) in LOOKBACK.items():
        start = F.when(at_mid, month_start(end, -when_mid[0], mid if when_mid[1] else 0)).otherwise(
            month_start(end, -otherwise[0], mid if otherwise[1] else 0))
        hit = col(rule) == name
        out = F.when(hit, start) if out is None else out.when(hit, start)
    return out.otherwise(F.lit(NO_WINDOW))


def plan_groupers(coverage: DataFrame, coverage_set: DataFrame, version: int = 2) -> DataFrame:
    """Billing attributes of a plan.

    Version 2: one row per plan name, that of the highest plan id, and only if that row is billed by
    invoice.  Version 1: one row per coverage key that is not billed by claim (unknown types drop out).
    """
    attrs = {c: c for c in GROUPERS.values()}
    named = coverage_set.where(F.col("type").isin(list(GROUPERS))).withColumn(
        "attr", F.element_at(F.create_map(*[F.lit(x) for kv in GROUPERS.items() for x in kv]), F.col("type")))
    if version == 1:
        wide = eav_pivot(named, ["coverage_key"], "attr", "name", attrs)
        plans = coverage.select("coverage_key", "plan_id", "plan_name", "payor_name").join(wide, "coverage_key")
        return plans.where(F.col("billing_type") != "CLAIM")
    level = coverage.where("is_benefit_plan = 1").select("coverage_key", "plan_id")
    wide = eav_pivot(named.join(level, "coverage_key"), ["plan_id"], "attr", "name", attrs)
    plans = coverage.select("plan_id", "plan_name", "payor_name").distinct().join(wide, "plan_id")
    top = first_per(plans, ["plan_name"], [F.col("plan_id").desc_nulls_last(), F.col("payor_name").asc_nulls_last()])
    return top.where(F.col("billing_type").isin(INVOICE_TYPES))


def plan_windows(groupers: DataFrame, run_date: dt.date, version: int = 2) -> DataFrame:
    """Billing window, next billing date and look-back start of every plan."""
    grid = month_grid("report_run_date")
    out = (
        groupers.withColumn("report_run_date", F.lit(run_date))
        .withColumns({
            "window_start": window_start("start_rule", grid),
            "window_end": window_end("end_rule", grid),
            "next_billing": next_billing("date_rule", grid),
        })
        .withColumn("lookback_start", lookback_start("lookback_rule", "end_rule", "window_end", version))
    )
    return out.where(F.col("date_rule").isNotNull()) if version == 2 else out


def primary_contract(plan, city, financial_class, strict: bool = False) -> Column:
    """Contract label.  As written, any plan that is not Californian ends in the second branch, so
    the branches after it only see NULL plans; ``strict=True`` uses the probable intent instead."""
    p = col(plan)
    medicaid, california = like_any(p, MEDICAID_PLANS), p.like(CALIFORNIA)

    def label(text):
        return concat_tsql(text, F.lit(" "), city, F.lit(" "), financial_class)

    first = (medicaid & california) if strict else (medicaid | california)
    second = (medicaid & ~california) if strict else (medicaid | ~california)
    return (
        F.when(first, label(F.lit("Anthem CA Medicaid")))
        .when(second, label(F.lit("Anthem Medicaid")))
        .when(like_any(p, COMMERCIAL_PLANS) & ~p.like("%ASO%"), label(F.lit("Anthem Commercial FI")))
        .when(like_any(p, MEDICARE_PLANS) & (col(financial_class) == "Medicare Replacement"), label(F.lit("Anthem Medicare")))
        .otherwise(label(p))
    )


# Columns the roster leaves blank.
BLANKS = ["health_plan_account_id", "health_plan_segment_id", "initial_visit_scheduled_date", "initial_visit_completed_date",
          "second_visit_completed_date", "completed_visits_this_month", "mbi", "suffix", "group_id", "hpbp", "member_id", "ipa"]


def patient_plans(member: DataFrame, mapping: DataFrame, external: DataFrame, coverage: DataFrame,
                  run_date: dt.date, version: int = 2) -> DataFrame:
    """One row per patient and combination of its coverages, with the first available plan.

    Version 2 prefers member over real-time over external coverage; version 1 external over real-time.
    """
    names = coverage.select("coverage_key", "plan_name")
    own = mapping
    if version == 2:
        own = mapping.where(F.col("effective_to") >= F.lit(run_date))
    own = own.select("patient_key", F.col("coverage_key").alias("own_key"), F.col("subscriber_number").alias("own_number"))
    ext = external.select("patient_key", F.col("coverage_key").alias("ext_key"), F.col("subscriber_number").alias("ext_number"))
    mem = member.select("patient_key", F.col("health_plan_name").alias("member_plan"), F.col("benefit_plan_key").alias("member_key"))
    anyone = own.select("patient_key").union(ext.select("patient_key")).union(mem.select("patient_key")).distinct()
    joined = (
        anyone.join(own, "patient_key", "left").join(ext, "patient_key", "left").join(mem, "patient_key", "left")
        .join(names.select(F.col("coverage_key").alias("own_key"), F.col("plan_name").alias("own_plan")), "own_key", "left")
        .join(names.select(F.col("coverage_key").alias("ext_key"), F.col("plan_name").alias("ext_plan")), "ext_key", "left")
    )
    if version == 1:
        order_key, order_name = ["ext_key", "own_key"], ["ext_plan", "own_plan"]
    else:
        order_key, order_name = ["member_key", "own_key", "ext_key"], ["member_plan", "own_plan", "ext_plan"]
    return joined.withColumns({"plan_key": F.coalesce(*order_key), "billed_plan": F.coalesce(*order_name)})


def billing_roster(tables: Mapping[str, DataFrame], run_date: dt.date, version: int = 2, strict_contract: bool = False,
                   visits_per_patient: bool = True) -> DataFrame:
    """Members to bill for the period of ``run_date``.

    ``tables``: coverage, coverage_set, patient, provider, member_attribute, coverage_mapping,
    external_coverage, visit, episode.  ``visits_per_patient=False`` keeps one row per visit and
    episode, as version 2 was written, before next-episode values are taken; by default visits are
    reduced to the latest one per patient and window first.
    """
    windows = plan_windows(plan_groupers(tables["coverage"], tables["coverage_set"], version), run_date, version)
    people = patient_plans(tables["member_attribute"], tables["coverage_mapping"], tables["external_coverage"],
                           tables["coverage"], run_date, version)
    if version == 1:
        windows = windows.withColumnRenamed("coverage_key", "plan_key").drop("plan_name", "payor_name")
        billed = people.join(windows, "plan_key")
    else:
        windows = windows.withColumnRenamed("plan_name", "billed_plan").drop("payor_name")
        billed = people.join(windows, "billed_plan")
    # Staged once, as the visits and the episodes both need it.
    spark = billed.sparkSession
    billed = materialise(spark, billed, "billed-members")

    visit = tables["visit"]
    done = visit.where(F.col("status").isin(VISIT_DONE if version == 2 else VISIT_DONE_V1))
    in_plan = billed
    if version == 2:
        done = done.where((F.col("closed") == 1) & real_key("visit_key") & (F.col("encounter_type") != BAD_ENCOUNTER))
        # NULL never passes NOT LIKE: only patients with real-time coverage stay.
        in_plan = billed.where(not_like_all("own_plan", EXCLUDED_PLANS))
    spans = in_plan.select("patient_key", "lookback_start", "window_end").distinct()
    days = done.select("patient_key", F.to_date("appointment_date").alias("visit_date"))
    if visits_per_patient:
        days = days.distinct()
    in_range = days.join(spans, "patient_key").where(F.col("visit_date").between(F.col("lookback_start"), F.col("window_end")))
    if visits_per_patient:
        visits = in_range.groupBy("patient_key").agg(F.max("visit_date").alias("visit_date"))
    else:
        visits = in_range.select("patient_key", "visit_date")

    episodes = tables["episode"].where(
        real_key("episode_key") & F.col("enrollment_date").isNotNull() & (F.col("type") == PROGRAM))
    patient = current_rows(tables["patient"])
    pcp = tables["provider"].select(F.col("provider_key").alias("pcp_key"), F.col("name").alias("pcp_name"))
    cov = tables["coverage"].select(
        F.col("coverage_key").alias("plan_key"), F.col("plan_name").alias("cov_plan"), F.col("payor_name").alias("cov_payor"),
        F.col("plan_id").alias("cov_plan_id"), F.col("financial_class").alias("cov_class"))
    rows = (
        episodes.join(billed, "patient_key")
        .where((F.col("enrollment_date") <= F.col("window_end"))
               & ((F.col("end_date") >= F.col("window_end")) | F.col("end_date").isNull()))
        .join(visits, "patient_key")
        .join(patient, "patient_key")
        .join(pcp, F.col("primary_care_key") == F.col("pcp_key"), "left")
        .join(cov, "plan_key", "left")
    )
    # The windows below read these rows several times.
    rows = materialise(spark, rows, "billing-rows")
    # Keys settle equal dates, which the original leaves open.
    ties = ["episode_key", "plan_key", "visit_date"]
    by_enrollment = next_row(
        rows.withColumn("_time", F.struct("enrollment_date", "status_instant")), ["mrn"], ["_time", *ties],
        {"reinstated": "enrollment_date", "next_status": "overall_status"})
    by_end = next_row(
        by_enrollment.withColumn("_time", F.struct("end_date", "status_instant")), ["mrn"], ["_time", *ties],
        {"end_date_2": "end_date"})
    first = first_per(by_end, ["mrn"], [
        F.col(c).asc_nulls_first() for c in ("enrollment_date", "status_instant", *ties)])
    end = F.col("window_end")
    again = ((F.col("end_date") <= end) & (F.col("reinstated") >= F.col("end_date")) & (F.col("reinstated") <= end)
             & ((F.col("end_date_2") > end) | F.col("end_date_2").isNull()))
    keep = ((F.col("end_date") > end) | F.col("end_date").isNull() | again) & (
        (F.col("death_date") > end) | F.col("death_date").isNull())
    number = F.coalesce("own_number", "ext_number")
    return first.where(keep).select(
        F.lit("D").alias("record_type"), F.col("name").alias("account_name"), F.col("mrn").alias("contact_id"),
        number.alias("health_plan_patient_id"), "first_name", "middle_name", "last_name",
        F.col("birth_date").alias("date_of_birth"), F.col("enrollment_date").alias("initial_active_date"),
        F.col("end_date").alias("discharge_date"), number.alias("primary_insurance_number"),
        F.col("cov_payor").alias("primary_insurance_name"), F.col("cov_plan_id").alias("ods_id"),
        F.col("state").alias("market"),
        F.when(F.col("type") == PROGRAM, PROGRAM_LABEL).otherwise(F.col("type")).alias("program_enrolled"),
        F.col("postal_code").alias("mailing_zip"),
        primary_contract("cov_plan", "city", "cov_class", strict_contract).alias("primary_contract"),
        F.when(F.col("reinstated").isNotNull(), F.col("next_status")).otherwise(F.col("overall_status")).alias("patient_status"),
        F.col("reinstated").alias("date_reinstated"), F.col("visit_date").alias("last_in_person_assessment"),
        F.col("death_date").alias("date_of_death"), F.col("pcp_name").alias("primary_care_physician"),
        F.col("state").alias("state_code"), F.col("patient_id").alias("patient_sfid"), "county",
        F.col("ext_number").alias("member_key"), F.col("visit_date").alias("last_relevant_date"),
        *[F.lit("").alias(b) for b in BLANKS])
