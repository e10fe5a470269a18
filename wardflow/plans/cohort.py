"""Comorbidity cohort of surgical cases."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clinical
from ..functions.conditions import COMORBIDITY, OSA_TEXT, PATIENT, flags, pattern_rows
from ..functions.dates import age_at, within_last_years
from ..functions.keys import current_rows
from ..operators.aggregates import list_distinct
from ..operators.asof import asof
from ..operators.cohort import Cohort
from ..operators.code_flags import code_masks, flag_columns, masks_per, pattern_table
from ..operators.intervals import interval_join
from ..operators.joins import all_of, named_rows
from ..operators.picks import first_per
from ..session import materialise

# Diagnosis events that count, and the medication window after surgery in days.
ENCOUNTER_DIAGNOSES = ["Encounter Diagnosis", "Encounter Diagnosis from External Source"]
MEDICATION_DAYS = 10
# Procedure codes of the shoulder cohort.
SHOULDER_CODES = ["29806", "23455", "29828", "23430", "23440", "23020", "29825", "23450", "29822", "23470", "23616", "23120",
                  "29824", "17999", "29827"]
FLAGS = flags(COMORBIDITY, PATIENT)


def readmission_lists(index: DataFrame, admissions: DataFrame, key: str) -> DataFrame:
    """Dates and reasons of admissions 1-30 and 31-90 days after ``index_day``, per (key, index_day).

    ``admissions`` has day and reason; one admission per day counts (smallest reason).  Both sides are
    distinct per (key, day) before they meet, so a day meets at most 90 others.
    """
    stays = index.select(key, "index_day").where("index_day is not null").distinct()
    days = admissions.where("day is not null").groupBy(key, "day").agg(F.min("reason").alias("reason"))
    pairs = interval_join(stays, days, key=key, left_date="index_day", right_date="day", lo=1, hi=90)
    soon = F.datediff("day", "index_day") <= 30
    item = F.struct("day", "reason")

    def listed(cond, field):
        items = F.sort_array(F.collect_list(F.when(cond, item)))
        text = F.transform(items, (lambda x: F.date_format(x["day"], "yyyy-MM-dd")) if field == "day" else (lambda x: x["reason"]))
        return F.when(F.size(items) > 0, F.array_join(text, ", "))

    return pairs.groupBy(key, "index_day").agg(
        listed(soon, "day").alias("dates_30"), listed(soon, "reason").alias("reasons_30"),
        listed(~soon, "day").alias("dates_90"), listed(~soon, "reason").alias("reasons_90"))


def condition_masks(spark: SparkSession, codes: DataFrame, code_format: str = "as_written") -> DataFrame:
    """Add the 46-flag mask to ICD-10 codes (``value``, ``display``)."""
    rows = pattern_rows(COMORBIDITY, PATIENT, code_format=code_format)
    patterns = pattern_table(spark, FLAGS, rows)
    sleep = (FLAGS.index("osa_flag"), F.coalesce(F.col("display").ilike(OSA_TEXT), F.lit(False)))
    return code_masks(codes, "value", patterns, sorted({len(t) for _, _, t in rows}), [sleep])


def condition_flags(tables: Mapping[str, DataFrame], patients: DataFrame | Cohort, code_format: str = "as_written") -> DataFrame:
    """46 flags per patient from ICD-10 encounter diagnoses."""
    cohort = patients if isinstance(patients, Cohort) else Cohort(patients, "patient_key")
    codes = tables["diagnosis_code"].where("type = 'ICD-10-CM'").select("diagnosis_key", "value", "display")
    coded = condition_masks(codes.sparkSession, codes, code_format).where("mask <> 0").groupBy("diagnosis_key").agg(
        F.bit_or("mask").alias("mask"))
    events = tables["diagnosis_event"].where((F.col("count") == 1) & F.col("type").isin(ENCOUNTER_DIAGNOSES)).select(
        "patient_key", "diagnosis_key")
    coded = materialise(codes.sparkSession, coded, "condition-codes")  # its size is known then, so that events meet it without an exchange
    # The cohort comes last: its join leaves the rows by patient, where the masks are put together.
    return masks_per(cohort.of(events.join(coded, "diagnosis_key")), ["patient_key"])


def case_procedures(tables: Mapping[str, DataFrame], base: DataFrame) -> DataFrame:
    """All procedure names and codes of a case; the primary code is the smallest."""
    codes = base.select("case_key", "case_id").join(tables["case_code"], "case_id").join(tables["procedure_code"], "procedure_id")
    return list_distinct(codes, ["case_key"], {"procedure_names": "procedure_name", "cpt_codes": "cpt"}, more=[F.min("cpt").alias("primary_cpt")])


def post_op_medications(tables: Mapping[str, DataFrame], base: DataFrame, cohort: Cohort) -> DataFrame:
    """Steroids and NSAIDs started on days 0 to 10 after surgery."""
    drugs = tables["medication"].select(
        "medication_key", F.coalesce("name", "generic_name").alias("med_name"),
        clinical.medication_class("name", "generic_name").alias("med_class")).where("med_class is not null")
    # A start meets at most one surgery day for each day of the window, repeats included; the lists drop them.
    starts = cohort.near(tables["medication_event"].select("patient_key", "medication_key", "start_date")).join(drugs, "medication_key").select(
        "patient_key", "start_date", "med_name", "med_class")
    index = base.select("patient_key", "surgery_date").distinct()
    pairs = interval_join(index, starts, key="patient_key", left_date="surgery_date", right_date="start_date", lo=0, hi=MEDICATION_DAYS)
    lists = list_distinct(pairs, ["patient_key", "surgery_date"], {
        "steroid_use": F.when(F.col("med_class") == "STEROID", F.col("med_name")),
        "nsaid_use": F.when(F.col("med_class") == "NSAID", F.col("med_name"))})
    return base.select("case_key", "patient_key", "surgery_date").join(lists, ["patient_key", "surgery_date"]).drop("patient_key", "surgery_date")


def first_ed_visit(tables: Mapping[str, DataFrame], base: DataFrame, cohort: Cohort) -> DataFrame:
    """First emergency visit 0 to 30 days after surgery."""
    visits = cohort.near(tables["ed_visit"]).groupBy("patient_key", "arrival_date").agg(
        F.min(F.coalesce("reason", F.lit("Not documented"))).alias("reason"))
    index = base.select("patient_key", "surgery_date").distinct()
    pairs = interval_join(index, visits, key="patient_key", left_date="surgery_date", right_date="arrival_date", lo=0, hi=30)
    first = pairs.groupBy("patient_key", "surgery_date").agg(
        F.min("arrival_date").alias("ed_visit_date"), F.min_by("reason", "arrival_date").alias("ed_visit_reason"))
    return base.select("case_key", "patient_key", "surgery_date").join(first, ["patient_key", "surgery_date"]).drop("patient_key", "surgery_date")


def pre_op_imaging(tables: Mapping[str, DataFrame], base: DataFrame, cohort: Cohort) -> DataFrame:
    """Last day before the surgery day with an exam, by modality.

    A patient's exams are reduced to their days, which the calendar bounds, before they meet the cases.
    """
    wanted = tables["procedure"].select("procedure_key", clinical.first_match("name", clinical.MODALITIES).alias("modality")).where(
        "modality is not null")
    names = list(clinical.MODALITIES)
    wanted = wanted.select("procedure_key", (F.array_position(F.array(*[F.lit(m) for m in names]), F.col("modality")) - 1).cast("int").alias("_m"))
    wanted = named_rows(wanted, "procedure_key", tables["imaging"], "procedure_key", "modalities")
    exams = cohort.near(tables["imaging"].select("patient_key", "procedure_key", F.to_date("exam_start").alias("day"))).join(wanted, "procedure_key")
    # Day and modality are one number, so that a patient has one set; it is parted by modality before the cases come.
    n = len(names)

    def of(i):
        return F.filter("_seen", lambda c: F.pmod(c, F.lit(n)) == i).alias(f"_{i}")

    days = exams.groupBy("patient_key").agg(F.collect_set(F.unix_date("day") * n + F.col("_m")).alias("_seen")).select(
        "patient_key", *[of(i) for i in range(n)])
    end = F.unix_date("surgery_date") * n
    last = [F.array_max(F.filter(f"_{i}", lambda c: c < end)) for i in range(n)]
    found = base.select("case_key", "patient_key", "surgery_date").join(days, "patient_key", "left")
    return found.select("case_key", *[
        F.date_from_unix_date(F.floor((last[i] - i) / n).cast("int")).alias(f"pre_op_{m}_date") for i, m in enumerate(names)])


def comorbidity_cohort(tables: Mapping[str, DataFrame], run_date: dt.date, cpt_codes: list[str], surgeon_like: str = "%",
                       years: int = 5, code_format: str = "as_written") -> DataFrame:
    """One row per case of the last ``years`` years with one of the procedure codes.

    ``tables``: surgical_case, provider, patient, location, case_code, procedure_code, procedure, billing_account,
    diagnosis, encounter, social_determinant, diagnosis_event, diagnosis_code, vitals, risk, supply_use, supply,
    medication_event, medication, admission, ed_visit, imaging.
    """
    case = tables["surgical_case"].where(within_last_years("surgery_date", run_date, years)).select(
        "case_key", "case_id", "patient_key", "encounter_key", "surgeon_key", "location_key", "surgery_date", "total_cost", "asa_rating")
    spark = case.sparkSession
    wanted = materialise(spark, tables["procedure_code"].where(F.col("cpt").isin(cpt_codes)).select("procedure_id"), "cohort-procedures")
    with_code = tables["case_code"].join(wanted, "procedure_id", "left_semi").select("case_id").distinct()
    surgeon = tables["provider"].where(F.upper("name").like(surgeon_like)).select(
        F.col("provider_key").alias("surgeon_key"), F.col("name").alias("surgeon_name"))
    surgeon = named_rows(surgeon, "surgeon_key", case, "surgeon_key", "cohort-surgeons")
    patient = current_rows(tables["patient"], valid="is_valid").select(
        "patient_key", "mrn", F.col("name").alias("patient_name"), "birth_date", "sex", "race", "ethnicity", "postal_code", "smoking_status")
    base = (
        case.join(with_code, "case_id", "left_semi").join(surgeon, "surgeon_key").join(patient, "patient_key")
        .join(tables["location"].select("location_key", F.col("name").alias("department_name")), "location_key")
    )
    base = materialise(spark, base, "cohort-base")
    cohort = Cohort(base, "patient_key")

    account = first_per(
        base.select("case_key", "encounter_key").join(tables["billing_account"], "encounter_key"), ["case_key"],
        [F.col("admission_date").desc_nulls_last(), F.col("discharge_date").desc_nulls_last(), F.col("account_key").asc()])
    account = materialise(spark, account.select(
        "case_key", "financial_class", F.col("admission_date").alias("stay_admission"), F.col("discharge_date").alias("stay_discharge"),
        F.col("los_days").alias("billing_los")), "cohort-stays")
    encounter = base.select("case_key", "encounter_key").join(tables["encounter"].select("encounter_key", "primary_diagnosis_key"), "encounter_key")
    names = tables["diagnosis"].select("diagnosis_key", "name")
    primary = named_rows(names, "diagnosis_key", tables["encounter"], "primary_diagnosis_key", "cohort-diagnoses")
    diagnosis = list_distinct(
        encounter.join(primary.withColumnRenamed("diagnosis_key", "primary_diagnosis_key"), "primary_diagnosis_key"), ["case_key"], {"diagnosis": "name"})
    social = list_distinct(
        base.select("case_key", "encounter_key").join(tables["social_determinant"], "encounter_key"), ["case_key"],
        {"social_domains": "domain", "social_concern": "concern", "social_entries": "interpretation"})
    masks = base.select("case_key", "patient_key").join(condition_flags(tables, cohort, code_format), "patient_key").drop("patient_key")
    vitals = asof(
        base.select("case_key", "patient_key", F.col("surgery_date").cast("timestamp_ntz").alias("at")),
        cohort.of(tables["vitals"]), key="patient_key", left_time="at", right_time="recorded",
        values=["bmi", "height", "weight"], tiebreak=["bmi", "height", "weight"]).select(
        "case_key", "pick.bmi", "pick.height", "pick.weight")
    risk = cohort.of(tables["risk"]).groupBy("patient_key").agg(
        F.max("charlson").alias("charlson_index"), F.max("functional_status").alias("functional_status"),
        F.max(F.when(F.col("days_since_admission") <= 90, 1).otherwise(0)).alias("recent_admission_flag"))
    risk = base.select("case_key", "patient_key").join(risk, "patient_key").drop("patient_key")
    supply = tables["supply"].where((F.col("is_current") == 1) & F.col("type").ilike("%implant%")).select("supply_key", "name")
    supply = materialise(spark, supply, "cohort-implants")  # a short list of known size
    implants = list_distinct(
        tables["supply_use"].where("count = 1").join(supply, "supply_key").join(base.select("case_key"), "case_key", "left_semi"),
        ["case_key"], {"implants": "name"})
    admissions = cohort.near(tables["admission"].where(
        F.col("admission_date").isNotNull() & F.col("principal_problem_key").isNotNull())).select(
        "patient_key", F.col("admission_date").alias("day"), F.col("principal_problem_key").alias("diagnosis_key"))
    icd10 = tables["diagnosis_code"].where("type = 'ICD-10-CM'").select("diagnosis_key").distinct()
    icd10 = named_rows(icd10, "diagnosis_key", tables["admission"], "principal_problem_key", "admission-codes")
    admissions = admissions.join(icd10, "diagnosis_key", "left_semi").join(
        named_rows(names, "diagnosis_key", tables["admission"], "principal_problem_key", "admission-names"), "diagnosis_key", "left").select(
        "patient_key", "day", F.coalesce("name", F.lit("Not documented")).alias("reason"))
    stays = base.select("case_key", "patient_key").join(account.select("case_key", F.col("stay_discharge").alias("index_day")), "case_key")
    readmitted = stays.join(readmission_lists(stays, admissions, "patient_key"), ["patient_key", "index_day"]).select(
        "case_key", F.col("dates_30").alias("readmission_dates_30"), F.col("reasons_30").alias("readmission_reasons_30"),
        F.col("dates_90").alias("readmission_dates_90"), F.col("reasons_90").alias("readmission_reasons_90"))

    age = age_at("birth_date", "surgery_date")
    main = base.select(
        "case_key", "case_id", "department_name", "mrn", "patient_name", "birth_date", age.alias("age_at_surgery"),
        F.when(age >= 65, "Yes").otherwise("No").alias("age_over_65_flag"), "sex", "race", "ethnicity", "postal_code", "surgery_date",
        "surgeon_name", "total_cost", "asa_rating", clinical.asa_score("asa_rating").alias("asa_score"), "smoking_status")
    out = all_of([
        case_procedures(tables, base), account, diagnosis, social, masks, vitals, risk, implants, post_op_medications(tables, base, cohort),
        pre_op_imaging(tables, base, cohort), readmitted, first_ed_visit(tables, base, cohort)], ["case_key"], main)
    return out.withColumn("bmi_over_30_flag", clinical.bmi_flag("bmi")).select(
        *[c for c in out.columns if c != "mask"], "bmi_over_30_flag", *flag_columns(FLAGS))
