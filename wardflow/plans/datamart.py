"""Surgical data mart: case rows with readmissions, current medication, imaging and staging."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import no_end_key, real_key
from ..operators.aggregates import list_ordered
from ..operators.cohort import Cohort
from ..operators.joins import all_of, named_rows
from ..session import materialise
from .registry import base_population, history_flags

STAGING = ["stage_description", "histologic_grade", "tumor_size_mm", "residual_tumor", "lymph_vascular_invasion", "lymphatic_invasion"]


def current_medication(tables: Mapping[str, DataFrame], cohort: Cohort) -> DataFrame:
    """Classes of medication started and not ended, one entry per order, in class order."""
    open_orders = tables["medication_event"].where(real_key("start_date_key", 1) & no_end_key("end_date_key")).select("patient_key", "medication_key")
    classed = open_orders.join(tables["medication"].select("medication_key", "pharmaceutical_class"), "medication_key", "left")
    # The cohort comes last: its join leaves the rows by patient, where the list needs them.
    return list_ordered(cohort.of(classed), ["patient_key"], "pharmaceutical_class", ["pharmaceutical_class"], "current_medication", sep=", ")


def _later_than(admission: str) -> Column:
    """Statuses in ``_status`` whose newest admission is later than ``admission``; no such admission, NULL."""
    after = F.filter("_status", lambda s: s["newest"] > F.col(admission))
    return F.when(F.size(after) > 0, F.array_join(F.transform(after, lambda s: s["status"]), ","))


def readmission_columns(tables: Mapping[str, DataFrame], base: DataFrame, earlier_dx: bool) -> tuple[DataFrame, DataFrame]:
    """(per patient: dates, diagnoses and ``_status``, the newest admission of each status; per case key that several rows
    share: the statuses that follow any of them).

    ``earlier_dx=True`` lists diagnoses of admissions before the case, as the original comparison reads;
    the default lists those after it.
    """
    spark = base.sparkSession
    first_last = base.groupBy("patient_key").agg(F.min("admission_date").alias("_first"), F.max("admission_date").alias("_last"))
    admissions = tables["admission"].where(F.col("admission_date").isNotNull()).join(first_last, "patient_key")
    later = admissions.where(F.col("admission_date") > F.col("_first"))
    days = later.groupBy("patient_key").agg(F.sort_array(F.collect_set("admission_date")).alias("_days"))
    dates = days.select("patient_key", F.array_join(F.transform("_days", lambda d: F.date_format(d, "yyyy-MM-dd")), ",").alias("readmission_dates"))
    side = admissions.where(F.col("admission_date") < F.col("_last")) if earlier_dx else later
    names = tables["diagnosis"].select(F.col("diagnosis_key").alias("principal_problem_key"), "name")
    names = named_rows(names, "principal_problem_key", tables["admission"], "principal_problem_key", "admission-names")
    reasons = list_ordered(side.join(names, "principal_problem_key"), ["patient_key"], "name", ["name"], "readmission_dx", sep=", ")
    # A status follows a case when its newest admission is later than the case: one entry per (patient, status).
    newest = later.groupBy("patient_key", F.col("confirmation_status").alias("status")).agg(F.max("admission_date").alias("newest"))
    status = newest.groupBy("patient_key").agg(F.sort_array(F.collect_list(F.struct("status", "newest"))).alias("_status"))
    # A case key of several rows gets the statuses of all of them; there are few such keys, if any.
    twice = base.groupBy("case_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("case_key")
    shared = base.select("case_key", "patient_key", "admission_date").join(materialise(spark, twice, "shared-cases"), "case_key")
    shared = shared.join(newest, "patient_key").where(F.col("newest") > F.col("admission_date")).groupBy("case_key").agg(
        F.array_join(F.sort_array(F.collect_set("status")), ",").alias("_shared"))
    return dates.join(reasons, "patient_key", "left").join(status, "patient_key", "left"), materialise(spark, shared, "shared-status")


def imaging_columns(tables: Mapping[str, DataFrame], base: DataFrame) -> DataFrame:
    """Per patient: the last image on an admission day before surgery, the last one after surgery until discharge, and
    number and first date of distinct images on or after the first discharge.

    A patient's days and stays are distinct sets that the calendar bounds; images are sent to them once, for all columns.
    """
    days = F.when(F.col("admission_date") < F.col("surgery_date"), F.col("admission_date"))
    stays = F.when(F.col("surgery_date") < F.col("discharge_date"), F.struct("surgery_date", "discharge_date"))
    spans = base.groupBy("patient_key").agg(
        F.collect_set(days).alias("_days"), F.collect_set(stays).alias("_stays"), F.min("discharge_date").alias("_from"))
    exams = tables["imaging"].where(F.col("exam_start").isNotNull()).select("patient_key", "exam_start", "imaging_key", "narrative")
    day = F.to_date("exam_start")
    exam = F.struct("exam_start", "imaging_key", "narrative")
    inside = F.exists("_stays", lambda s: (day > s["surgery_date"]) & (day <= s["discharge_date"]))
    follows = day >= F.col("_from")
    shown = exams.join(spans, "patient_key").groupBy("patient_key").agg(
        F.max(F.when(F.array_contains("_days", day), exam)).alias("_pre"), F.max(F.when(inside, exam)).alias("_post"),
        F.count_distinct(F.when(follows, F.struct(day.alias("day"), "narrative"))).alias("_n"), F.min(F.when(follows, day)).alias("_first"))
    return shown.select(
        "patient_key", F.to_date("_pre.exam_start").alias("pre_op_imaging_date"), F.col("_pre.narrative").alias("pre_op_imaging_result"),
        F.to_date("_post.exam_start").alias("post_op_imaging_date"), F.col("_post.narrative").alias("post_op_imaging_result"),
        F.when(F.col("_n") > 0, F.col("_n")).alias("follow_up_images"), F.col("_first").alias("first_follow_up_imaging_date"))


def follow_up_imaging(tables: Mapping[str, DataFrame], base: DataFrame) -> DataFrame:
    """Distinct images on or after the first discharge of a patient, long form."""
    first = base.groupBy("patient_key").agg(F.min("discharge_date").alias("_from"))
    return tables["imaging"].join(first, "patient_key").where(F.to_date("exam_start") >= F.col("_from")).select(
        "patient_key", F.to_date("exam_start").alias("follow_up_imaging_date"), F.col("narrative").alias("follow_up_imaging_result")).distinct()


def surgical_datamart(tables: Mapping[str, DataFrame], surgeon_like: str, earlier_dx: bool = False,
                      expand_follow_up: bool = False) -> DataFrame:
    """Case rows; ``expand_follow_up=True`` gives one row per case and follow-up image, as the original does,
    otherwise their number and first date (``follow_up_imaging`` has the rows)."""
    base = base_population(tables, surgeon_like, performed_only=False)
    spark = base.sparkSession
    base = materialise(spark, base, "datamart-base")
    per_patient, shared = readmission_columns(tables, base, earlier_dx)
    images = imaging_columns(tables, base)
    staging = tables["cancer_staging"].select("patient_key", *STAGING).distinct()
    cohort = Cohort(base, "patient_key")
    flags = history_flags(tables, cohort)
    facts = ["los", "post_op_los", "sex", "bmi", "height", "weight", "asa_rating", "diabetes_mellitus", "hypertension"]
    main = base.select("case_key", "patient_key", "mrn", "surgery_date", "procedure_name", "admission_date", "discharge_date", *facts).join(
        shared, "case_key", "left")
    follow = []
    if expand_follow_up:
        images = images.drop("follow_up_images", "first_follow_up_imaging_date")
        follow = [follow_up_imaging(tables, base)]
    wide = all_of([per_patient, current_medication(tables, cohort), images, *follow, staging, flags], ["patient_key"], main)
    out = wide.withColumns({"readmission_status": F.coalesce("_shared", _later_than("admission_date")), **{
        c: F.coalesce(c, F.lit(0)) for c in ("hyperlipidemia", "coronary_artery_disease")}})
    head = ["patient_key", *[c for c in main.columns if c not in ("patient_key", "_shared")], "readmission_status"]
    return out.select(*head, *[c for c in wide.columns if c not in (*head, "_shared", "_status")])
