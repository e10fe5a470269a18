"""Surgical registry: one wide row per surgical case."""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clinical
from ..functions.dates import boundary_diff
from ..functions.keys import current_rows, real_key
from ..functions.text import concat_strict
from ..operators.aggregates import list_ordered
from ..operators.cohort import Cohort
from ..operators.code_flags import code_masks, flag_columns, masks_per, pattern_table
from ..operators.followup import BUCKETS, followup_buckets
from ..operators.intervals import later_days
from ..operators.joins import all_of, named_rows
from ..operators.picks import latest_per
from ..operators.sweep import BACK, FORWARD, Ask, sweep
from ..session import in_place, materialise

#: Bits of the filter that spares texts of other results the exchange: 16 MB at most, for some 30 million results with a text.
TEXT_BITS = 1 << 27
#: Cases of a task that puts the wide rows together: some 10 kB of sorted rows each, so that none has to spill.
TASK_CASES = 1 << 15
# Diagnosis prefixes of the two history flags.
HISTORY = {"hyperlipidemia": "E78.", "coronary_artery_disease": "I25."}


def history_flags(tables: Mapping[str, DataFrame], cohort: Cohort) -> DataFrame:
    """0/1 per patient: any ICD-10 code with the prefix."""
    spark, flags = cohort.keys.sparkSession, list(HISTORY)
    patterns = pattern_table(spark, flags, [(f, "prefix", p) for f, p in HISTORY.items()])
    codes = tables["diagnosis_code"].where("type = 'ICD-10-CM'").select("diagnosis_key", "value").distinct()
    coded = code_masks(codes, "value", patterns, sorted({len(p) for p in HISTORY.values()})).where("mask <> 0")
    # The codes in question are few; written, their size is known, and only events with one of them are exchanged by patient.
    coded = materialise(spark, coded.select("diagnosis_key", "mask"), "history-codes")
    events = Cohort(coded, "diagnosis_key").near(tables["diagnosis_event"].select("patient_key", "diagnosis_key"))
    events = cohort.of(events.join(coded, "diagnosis_key"))
    return masks_per(events, ["patient_key"]).select("patient_key", *flag_columns(flags))


def base_population(tables: Mapping[str, DataFrame], surgeon_like: str, performed_only: bool = True) -> DataFrame:
    """Cases of the matching surgeons with patient, social history, vitals and length of stay."""
    case = tables["surgical_case"].where(
        real_key("case_key") & real_key("surgery_date_key", 1) & (F.col("canceled") == 0)
        & (F.length("reason_not_performed") == 0))
    if performed_only:
        case = case.where(F.col("procedure_complete").isNotNull())
    surgeon = tables["provider"].where(F.upper("name").like(surgeon_like)).select(F.col("provider_key").alias("surgeon_key"))
    case = case.join(named_rows(surgeon.distinct(), "surgeon_key", case, "surgeon_key", "surgeons"), "surgeon_key")
    patient = current_rows(tables["patient"], test="test").select(
        "patient_key", "mrn", "patient_id", "age_in_years", "sex", "race", "ethnicity")
    # All that is known of a patient is joined for each patient, so the wide rows of the cases are exchanged once.
    people = materialise(case.sparkSession, patient.join(case.select("patient_key").distinct(), "patient_key", "left_semi"), "people")
    # The latest of the cohort's patients only.
    social = tables["social_history"].join(people.select("patient_id").distinct(), "patient_id", "left_semi")
    social = latest_per(social, ["patient_id"], "contact_date", ["smoking", "smokeless"]).select("patient_id", "smoking", "smokeless")
    vitals = tables["vitals"].join(people.select("patient_key").distinct(), "patient_key", "left_semi")
    vitals = latest_per(vitals, ["patient_key"], "recorded", ["bmi", "height", "weight"]).select("patient_key", "bmi", "height", "weight")
    listed = tables["diagnosis_list"].select(
        "patient_key", F.greatest("type_1_diabetes", "type_2_diabetes").alias("diabetes_mellitus"), "hypertension")
    known = people.join(social, "patient_id", "left").join(vitals, "patient_key", "left").join(listed, "patient_key", "left")
    procedure = tables["procedure"].select("procedure_key", F.col("name").alias("procedure_name"))
    procedure = named_rows(procedure, "procedure_key", case, "procedure_key", "procedures")
    rows = case.join(procedure, "procedure_key", "left").join(known, "patient_key")
    return rows.withColumns({
        "los": boundary_diff("day", "admission_instant", "discharge_instant"),
        "post_op_los": boundary_diff("day", "procedure_complete", "discharge_instant"),
        "diabetes_mellitus": F.coalesce("diabetes_mellitus", F.lit(0)),
        "hypertension": F.coalesce("hypertension", F.lit(0)),
    })


def case_labs(tables: Mapping[str, DataFrame], cohort: Cohort) -> DataFrame:
    """Results in one of the report's families, one row per (result, family, category): those of the cohort and, where its
    filter lets them through, few others, which no case meets.

    Names are classified in the component list, so the result table meets a short list of wanted keys.  The results are written once, and
    only those of the text families go on to the text table.  Orders are named for pathology, times of release for follow-up labs.
    """
    c = tables["lab_component"]
    pathology = F.col("type").ilike(clinical.PATHOLOGY_TYPE)
    path_name = F.create_map(*[F.lit(x) for kv in clinical.PATHOLOGY.items() for x in kv])
    families = {
        "lab": clinical.first_match("name", clinical.LABS), "urine": clinical.first_match("name", clinical.URINE),
        "culture": clinical.first_match("name", clinical.CULTURE), "stone": clinical.first_match("name", clinical.STONE),
        "pathology": F.when(pathology, F.try_element_at(path_name, F.col("name"))),
        "synoptic": F.when(pathology & (F.col("subtype") == clinical.SYNOPTIC), F.col("name")),
    }
    pairs = F.array(*[F.struct(F.lit(f).alias("family"), e.alias("category")) for f, e in families.items()])
    wanted = c.where(F.col("name").isNotNull()).select("component_key", F.inline(pairs)).where("category is not null")
    spark, plain = c.sparkSession, F.col("family").isin("lab", "urine")
    labs = cohort.near(tables["lab_result"]).join(wanted, "component_key").select(
        "patient_key", "family", "category", F.when(plain, F.col("value")).alias("value"),
        F.when(F.col("family").isin("pathology", "synoptic"), F.col("order_id")).alias("order_id"), "collected",
        F.when((F.col("family") == "lab") & F.col("category").isin(clinical.FOLLOWUP_LABS), F.col("resulted")).alias("resulted"), "result_key",
        F.when(~plain, F.col("procedure_key")).alias("procedure_key"))
    labs = materialise(spark, labs, "registry-results")
    texts = tables["lab_text"].select("result_key", F.col("value").alias("text_value"), F.col("comment").alias("text_comment"))
    stone = tables["procedure"].where(F.col("name").ilike(clinical.STONE_PROCEDURE)).select("procedure_key", F.lit(True).alias("_stone")).distinct()
    with_text = labs.where(~plain).drop("value")
    # Texts of other results are left out in the scan.
    texts = Cohort(with_text, "result_key", TEXT_BITS).near(texts)
    with_text = with_text.join(texts, "result_key", "left").join(stone, "procedure_key", "left").where(
        "family <> 'stone' or (_stone and length(text_comment) > 0)")
    shown = (
        F.when(F.col("family") == "culture", concat_strict("text_value", F.lit("   "), "text_comment"))
        .when(F.col("family") == "stone", F.col("text_comment")).otherwise(F.col("text_value"))
    )
    columns = ["patient_key", "family", "category", "shown", "order_id", "collected", "resulted", "result_key"]
    with_text = materialise(spark, with_text.withColumn("shown", shown).select(*columns), "registry-texts")
    return labs.where(plain).withColumnRenamed("value", "shown").select(*columns).unionByName(with_text)


#: Which results the report shows: question -> (time of the case, direction, categories by family).
QUESTIONS = {
    "before": ("procedure_start", BACK, {"lab": list(clinical.LABS), "urine": list(clinical.URINE), "culture": ["culture"]}),
    "after": ("procedure_complete", FORWARD, {"lab": list(clinical.LABS), "urine": list(clinical.URINE)}),
    "path": ("start_day", FORWARD, {"pathology": list(clinical.PATHOLOGY.values())}),
    "stone": ("procedure_start", FORWARD, {"stone": list(clinical.STONE)}),
}


def lab_picks(index: DataFrame, labs: DataFrame) -> DataFrame:
    """(patient_key, case_key, ask, category, shown, order_id) of every result that the report shows.

    All questions are answered in one sweep over ids; texts are joined to the ids that were picked.
    """
    coded = labs.withColumn("_fc", F.concat_ws(":", "family", "category"))
    asks = [Ask(name, time, way, tuple(f"{f}:{c}" for f, cs in families.items() for c in cs)) for name, (time, way, families) in QUESTIONS.items()]
    found = sweep(index, coded, asks, probe="case_key", key="patient_key", event_time="collected", event="result_key", category="_fc",
                  carry=["shown", "order_id"])
    return found.select("patient_key", F.col("probe").alias("case_key"), "ask", "category", "shown", "order_id")


def shown_columns(pairs: dict[tuple[str, str], str]) -> list[Column]:
    """Aggregates of a case's picks: a column for each (question, family:category)."""
    return [F.max(F.when((F.col("ask") == a) & (F.col("category") == c), F.col("shown"))).alias(out) for (a, c), out in pairs.items()]


def case_keys(base: DataFrame) -> list[str]:
    """Columns that name a case.  The patient is one of them, so that everything is joined where the patient's rows lie, unless
    patients share a case key: what is found for such a case is put together whoever the patient is."""
    patients = base.groupBy("case_key").agg(F.min("patient_key").alias("a"), F.max("patient_key").alias("b"))
    return ["patient_key", "case_key"] if patients.where("a <> b").isEmpty() else ["case_key"]


def per_case(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per case from rows per (patient, case), sent as they are: hardly any are put together before."""
    sent = parts.repartition(keys[0])
    if "patient_key" in keys:
        return sent
    return sent.groupBy("case_key").agg(*[F.max(c).alias(c) for c in parts.columns if c not in ("case_key", "patient_key")])


def readmissions(tables: Mapping[str, DataFrame], index: DataFrame, cohort: Cohort, fmt: str, keys: list[str]) -> DataFrame:
    """Dates, diagnoses and last status of admissions after the discharge of a case.

    The newest admission of a diagnosis after a discharge is the patient's newest one with that diagnosis, so
    one row per (patient, diagnosis) is enough; likewise the last status needs one row per patient.
    """
    admissions = cohort.of(tables["admission"].where(F.col("admission_date").isNotNull()))
    names = tables["diagnosis"].select(F.col("diagnosis_key").alias("principal_problem_key"), F.col("name").alias("dx_name"))
    dated = later_days(index.select("case_key", "patient_key", "discharge_date"), admissions, key="patient_key",
                       left_date="discharge_date", right_date="admission_date", out="readmission_dates", fmt=fmt, descending=True)
    by_name = admissions.where(F.col("principal_problem_key").isNotNull()).join(names, "principal_problem_key", "left")
    newest = by_name.groupBy("patient_key", "dx_name").agg(F.max("admission_date").alias("day"))
    digest = newest.where("dx_name is not null").groupBy("patient_key").agg(
        F.sort_array(F.collect_list(F.struct("day", "dx_name")), asc=False).alias("_dx"))
    last = latest_per(admissions, ["patient_key"], "admission_date", ["admission_key"]).select(
        "patient_key", F.col("admission_date").alias("_last"), "confirmation_status")
    joined = dated.join(digest, "patient_key", "left").join(last, "patient_key", "left")
    later = F.filter("_dx", lambda x: x["day"] > F.col("discharge_date"))
    return joined.select(
        *keys, "readmission_dates",
        F.when(F.size(later) > 0, F.array_join(F.transform(later, lambda x: x["dx_name"]), ",")).alias("readmission_reasons"),
        F.when(F.col("_last") > F.col("discharge_date"), F.col("confirmation_status")).alias("readmission_status"))


def op_notes(tables: Mapping[str, DataFrame], index: DataFrame, cohort: Cohort, service: str, keys: list[str]) -> DataFrame:
    note = cohort.of(tables["clinical_note"].where(
        (F.lower("type") == "op note") & (F.col("status") == "Signed") & (F.col("service") == service)))
    last = latest_per(note, ["patient_key", "service_date"], "last_edited", ["text"]).select(
        "patient_key", F.col("service_date").alias("surgery_date"), F.col("text").alias("op_note"))
    return index.select("case_key", "patient_key", "surgery_date").join(last, ["patient_key", "surgery_date"]).select(*keys, "op_note").repartition(keys[0])


def synoptic_text(labs: DataFrame, index: DataFrame, finals: DataFrame, keys: list[str]) -> DataFrame:
    """Checklist answers of the order of the final report, newest first, one per question.  ``finals``: the keys and order_id."""
    rows = labs.where("family = 'synoptic' and shown is not null").select(
        "patient_key", "order_id", "category", "shown", "collected", "result_key")
    asked = index.select("case_key", "patient_key", "procedure_start").join(finals, keys)
    hits = asked.join(rows, ["patient_key", "order_id"]).where(
        boundary_diff("minute", "procedure_start", "collected") >= 1)
    answer = F.struct(F.concat(F.col("category"), F.lit("=="), F.col("shown")).alias("text"), F.col("collected"))
    first = hits.groupBy(*keys, "category").agg(F.min_by(answer, F.struct("collected", "result_key")).alias("_a"))
    return list_ordered(first.select(*keys, "_a.text", "_a.collected"), keys, "text", ["collected"],
                        "synoptic_report", descending=True).repartition(keys[0])


def imaging_picks(tables: Mapping[str, DataFrame], index: DataFrame, cohort: Cohort, keys: list[str]) -> DataFrame:
    """Last CT and MR at or before the start, first ones at or after the end."""
    wanted = tables["procedure"].select("procedure_key", clinical.first_match("name", clinical.CT_OR_MR).alias("modality")).where(
        "modality is not null")
    exams = cohort.near(tables["imaging"].join(wanted, "procedure_key")).select(
        "patient_key", "imaging_key", "exam_start", "modality", "narrative", "impression")
    exams = materialise(index.sparkSession, exams, "registry-images")
    shown = {"pre_op": ("procedure_start", BACK), "post_op": ("procedure_complete", FORWARD)}
    asks = [Ask(tag, time, way, tuple(clinical.CT_OR_MR)) for tag, (time, way) in shown.items()]
    picked = sweep(index, exams, asks, probe="case_key", key="patient_key", event_time="exam_start", event="imaging_key", category="modality",
                   carry=["exam_start", "narrative", "impression"])
    cell = lambda a, m, c: F.max(F.when((F.col("ask") == a) & (F.col("category") == m), F.col(c)))
    columns = {"date": "exam_start", "result": "narrative", "impression": "impression"}
    wide = picked.groupBy("patient_key", F.col("probe").alias("case_key")).agg(*[
        cell(a, m, c).alias(f"{a}_{m}_{n}") for a in shown for m in clinical.CT_OR_MR for n, c in columns.items()])
    with in_place(index.sparkSession):
        return per_case(materialise(index.sparkSession, wide, "registry-image-picks"), keys)


def surgical_registry(tables: Mapping[str, DataFrame], surgeon_like: str, service: str = "Urology",
                      date_format: str = "MM/dd/yyyy") -> DataFrame:
    """One row per case.

    ``tables``: surgical_case, provider, patient, procedure, vitals, diagnosis_list, social_history,
    diagnosis_event, diagnosis_code, diagnosis, admission, clinical_note, lab_result, lab_component, lab_text,
    imaging.  The cohort, its results and their picks are written once and read by every feature.
    """
    base = base_population(tables, surgeon_like).select(
        "case_key", "patient_key", "mrn", F.col("age_in_years").alias("age"), "sex", "race", "ethnicity",
        "height", "weight", "bmi", "asa_rating", "diabetes_mellitus", "hypertension", "smoking", "smokeless", "admission_date",
        "surgery_date", "discharge_date", "procedure_name", "los", "post_op_los", "procedure_start", "procedure_complete")
    spark = base.sparkSession
    base = materialise(spark, base, "registry-base")
    keys = case_keys(base)
    index = base.select("case_key", "patient_key", "surgery_date", "discharge_date", "procedure_start", "procedure_complete",
                        F.date_trunc("day", "procedure_start").cast("timestamp_ntz").alias("start_day"))
    cohort = Cohort(base, "patient_key")
    labs = case_labs(tables, cohort)

    lab, urine = list(clinical.LABS), list(clinical.URINE)
    follow = followup_buckets(
        index, labs.where((F.col("family") == "lab") & F.col("category").isin(clinical.FOLLOWUP_LABS)), key="patient_key",
        index_time="procedure_complete", component="category", time="collected", values=["shown", "resulted"], tiebreak=["result_key"],
        carry=["case_key"])
    wide = follow.repartition(keys[0]).groupBy(*keys).agg(
        *[F.max(F.when((F.col("category") == c) & (F.col("bucket") == b), F.col("shown"))).alias(f"{c}_{b}")
          for b in BUCKETS for c in clinical.FOLLOWUP_LABS],
        *[F.max(F.when((F.col("category") == c) & (F.col("bucket") == "ygt1"), F.col("resulted"))).alias(f"{c}_ygt1_date")
          for c in clinical.FOLLOWUP_LABS])
    shown = {("before", f"lab:{c}"): f"{c}_pre_op" for c in lab} | {("before", f"urine:{c}"): f"urine_{c}_pre_op" for c in urine}
    shown |= {("before", "culture:culture"): "urine_culture_pre_op"}
    shown |= {("after", f"lab:{c}"): f"{c}_post_op" for c in lab} | {("after", f"urine:{c}"): f"urine_{c}_post_op" for c in urine}
    shown |= {("path", f"pathology:{c}"): f"pathology_{c}" for c in ("case_report", "final_report")}
    shown |= {("stone", f"stone:{c}"): f"calculi_{c}" for c in clinical.STONE}
    # The picks of a case lie together: they become a row before they are written or sent.
    picks = lab_picks(index, labs)
    final = F.when((F.col("ask") == "path") & (F.col("category") == "pathology:final_report"), F.col("order_id"))
    with in_place(spark):
        picks = materialise(spark, picks.groupBy("patient_key", "case_key").agg(
            *shown_columns(shown), F.collect_set(final).alias("final_orders")), "registry-picks")
    flags = index.select("case_key", "patient_key").join(history_flags(tables, cohort), "patient_key").select(*keys, *HISTORY)

    finals = picks.select(*keys, F.explode("final_orders").alias("order_id"))
    main = base.drop("procedure_start", "procedure_complete", *{"patient_key"}.difference(keys)).repartition(keys[0])
    parts = [
        flags, readmissions(tables, index, cohort, date_format, keys),
        per_case(picks.drop("final_orders"), keys), op_notes(tables, index, cohort, service, keys), wide,
        synoptic_text(labs, index, finals, keys), imaging_picks(tables, index, cohort, keys)]
    out = all_of(parts, keys, main).withColumns({f: F.coalesce(f, F.lit(0)) for f in HISTORY}).drop("patient_key")
    # Written here: rows that lie by patient already are not sent again, and neighbours are alike and small.
    with in_place(spark, max(spark.sparkContext.defaultParallelism, ceil(base.count() / TASK_CASES))):
        return materialise(spark, out, "registry")
