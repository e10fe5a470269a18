"""Plans and results of reports whose shuffles or task memory grew with the input."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardflow.operators.cohort import Cohort
from wardflow.operators.joins import named_rows
from wardflow.plans import cohort as cohort_plan
from wardflow.plans import datamart, registry, rosters

DAY = dt.date


def test_parent_company_holds_no_joined_rows_in_memory(spark):
    """The sources are distinct, so is their join: no aggregate over it.  Repeated and NULL keys change nothing."""
    frame = spark.createDataFrame
    tables = {
        "coverage": frame([(1, "P1", "A"), (2, "P1", "B"), (3, None, "A"), (4, "P2", "*Not Applicable")], "coverage_key long, plan_name string, parent_company string"),
        "episode": frame([(1,), (1,), (2,), (3,), (None,)], "patient_key long"),
        "patient": frame([(1, 1), (1, 1), (2, 1), (3, 0), (None, 1)], "patient_key long, is_current int"),
        "eligibility": frame([(1, 1), (1, 2), (1, 4), (2, 3), (2, None), (None, 1)], "patient_key long, coverage_key long"),
        "coverage_mapping": frame([(1, 2, dt.date(2001, 1, 1)), (1, 2, dt.date(2002, 1, 1)), (2, 1, dt.date(1990, 1, 1))],
                                  "patient_key long, coverage_key long, effective_to date"),
        "external_coverage": frame([(2, 9), (2, 3)], "patient_key long, coverage_key long"),
    }
    got = rosters.parent_company(tables, dt.date(1998, 4, 1))
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    ods, rte = [("P1", "A"), ("P1", "B"), ("P2", None)], [("P1", "A"), ("P1", "B")]
    want = [(1, *o, *r, None, None) for o in ods for r in rte] + [(2, None, None, None, None, None, None)]
    assert rows == sorted(want, key=str)
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]


def test_data_mart_sends_images_once(spark):
    """Last image on an admission day, last one of a stay and the follow-ups from one reading of the images."""
    base = spark.createDataFrame([
        (1, DAY(2001, 1, 1), DAY(2001, 1, 2), DAY(2001, 1, 4)), (1, DAY(2001, 3, 1), DAY(2001, 3, 1), DAY(9999, 12, 31)),
        (2, DAY(2001, 1, 1), DAY(2001, 1, 2), None), (3, None, None, DAY(2001, 1, 1)), (4, DAY(2001, 1, 5), DAY(2001, 1, 2), DAY(2001, 1, 1))],
        "patient_key long, admission_date date, surgery_date date, discharge_date date")
    at = lambda month, day, hour: dt.datetime(2001, month, day, hour)
    images = spark.createDataFrame([
        (1, "a", at(1, 1, 3), "first"), (1, "b", at(1, 1, 9), "low"), (1, "c", at(1, 1, 9), "high"), (1, "d", at(1, 4, 1), "out"), (1, "e", at(1, 5, 1), "between"),
        (1, "f", at(3, 1, 5), "same day"), (1, "g", None, "no time"), (1, "h", at(1, 4, 2), None), (1, "i", at(1, 4, 3), None),
        (2, "j", at(1, 1, 1), "pre"), (2, "k", at(1, 3, 1), "open stay"), (3, "l", at(1, 1, 1), "on"), (4, "m", at(1, 1, 1), "backward"), (None, "n", at(1, 1, 1), "x")],
        "patient_key long, imaging_key string, exam_start timestamp_ntz, narrative string")
    got = datamart.imaging_columns({"imaging": images}, base)
    rows = {r[0]: tuple(r)[1:] for r in got.collect()}
    assert rows == {
        1: (DAY(2001, 1, 1), "high", DAY(2001, 1, 4), None, 4, DAY(2001, 1, 4)),
        2: (DAY(2001, 1, 1), "pre", None, None, None, None), 3: (None, None, None, None, 1, DAY(2001, 1, 1)),
        4: (None, None, None, None, 1, DAY(2001, 1, 1))}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [patient_key#") <= 2  # cases and images, each once


def test_status_of_a_case_needs_no_exchange_by_case(spark):
    """Statuses go with the patient; only a case key of several rows is put together by case."""
    case = [(7, 1, DAY(2001, 1, 1)), (8, 1, DAY(2001, 2, 1)), (8, 2, DAY(2001, 1, 1)), (9, 3, None), (10, 4, DAY(2001, 1, 1))]
    base = spark.createDataFrame(case, "case_key long, patient_key long, admission_date date")
    tables = {
        "admission": spark.createDataFrame([
            (1, DAY(2001, 1, 5), 1, "B"), (1, DAY(2001, 1, 6), 2, "A"), (1, DAY(2000, 1, 1), 2, "Z"), (2, DAY(2001, 1, 7), 1, "C"), (3, DAY(2001, 1, 7), 1, "C"),
            (4, DAY(2001, 1, 7), None, None)], "patient_key long, admission_date date, principal_problem_key long, confirmation_status string"),
        "diagnosis": spark.createDataFrame([(1, "one"), (2, "two"), (2, "two"), (3, "unused")], "diagnosis_key long, name string")}
    per_patient, shared = datamart.readmission_columns(tables, base, False)
    assert [tuple(r) for r in shared.collect()] == [(8, "C")]
    wide = base.join(per_patient, "patient_key", "left").join(shared, "case_key", "left").select(
        "case_key", "patient_key", F.coalesce("_shared", datamart._later_than("admission_date")).alias("status"), "readmission_dx")
    assert sorted(tuple(r) for r in wide.collect()) == [
        (7, 1, "A,B", "one, two, two"), (8, 1, "C", "one, two, two"), (8, 2, "C", "one"), (9, 3, None, None), (10, 4, "", None)]


def test_named_rows_are_the_dimension_rows_that_facts_name(spark):
    dim = spark.range(1000).selectExpr("id % 500 AS k", "id AS v")
    facts = spark.createDataFrame([(3,), (3,), (499,), (700,), (None,)], "f long")
    got = named_rows(dim, "k", facts, "f", "named")
    assert sorted(tuple(r) for r in got.collect()) == [(3, 3), (3, 503), (499, 499), (499, 999)]


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_case_procedures_read_the_codes_once(spark):
    tables = {
        "case_code": spark.createDataFrame([("C1", 1), ("C1", 2), ("C1", 2), ("C2", 3), ("C3", None)], "case_id string, procedure_id long"),
        "procedure_code": spark.createDataFrame([(1, "29999", "b"), (2, "10000", "a"), (3, None, "c")], "procedure_id long, cpt string, procedure_name string")}
    base = spark.createDataFrame([(1, "C1"), (2, "C2"), (3, "C3")], "case_key long, case_id string")
    got = cohort_plan.case_procedures(tables, base)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a || b", "10000 || 29999", "10000"), (2, "c", None, None)]
    assert _plan(got).count("LogicalRDD [case_id#") == 1  # twice before: once for the lists, once for the primary code


def test_days_of_images_before_surgery_need_no_window(spark):
    """Old dates, the surgery day itself, other patients, repeated cases and missing times."""
    at = lambda year, day, hour: dt.datetime(year, 1, day, hour)
    tables = {
        "procedure": spark.createDataFrame([(1, "CT ABDOMEN"), (2, "MR PELVIS"), (3, "STONE ANALYSIS")], "procedure_key long, name string"),
        "imaging": spark.createDataFrame([
            (1, 1, at(1965, 3, 23)), (1, 1, at(1965, 2, 1)), (1, 1, at(2001, 5, 0)), (1, 2, at(2001, 4, 23)), (1, 2, at(2001, 4, 1)), (1, 3, at(2001, 1, 1)),
            (2, 1, at(2001, 9, 1)), (2, 2, None), (9, 1, at(2001, 1, 1)), (None, 1, at(2001, 1, 1))], "patient_key long, procedure_key long, exam_start timestamp_ntz")}
    base = spark.createDataFrame([(10, 1, DAY(2001, 1, 5)), (10, 1, DAY(2001, 1, 5)), (11, 2, DAY(2001, 1, 9)), (12, 3, DAY(2001, 1, 9)), (13, 1, None)],
                                 "case_key long, patient_key long, surgery_date date")
    got = cohort_plan.pre_op_imaging(tables, base, Cohort(base, "patient_key"))
    rows = sorted(((r.case_key, r.pre_op_ct_date, r.pre_op_mri_date) for r in got.collect()), key=str)
    assert rows == [(10, DAY(1965, 1, 3), DAY(2001, 1, 4))] * 2 + [(11, None, None), (12, None, None), (13, None, None)]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString() and "asof" not in _plan(got)


def test_medication_starts_are_not_made_distinct_first(spark):
    tables = {
        "medication": spark.createDataFrame([(1, "Prednisone 5 mg", None), (2, None, "ketorolac"), (3, "Lisinopril", None)],
                                            "medication_key long, name string, generic_name string"),
        "medication_event": spark.createDataFrame([(1, 1, DAY(2001, 1, d)) for d in (1, 1, 4, 11, 12)] + [
            (1, 2, DAY(2001, 1, 11)), (1, 2, DAY(2001, 1, 11)), (1, 3, DAY(2001, 1, 2)), (2, 1, DAY(2001, 1, 2)), (1, 1, None)],
            "patient_key long, medication_key long, start_date date")}
    base = spark.createDataFrame([(10, 1, DAY(2001, 1, 1)), (11, 1, DAY(2001, 1, 12)), (12, 3, DAY(2001, 1, 1))], "case_key long, patient_key long, surgery_date date")
    got = cohort_plan.post_op_medications(tables, base, Cohort(base, "patient_key"))
    assert sorted(tuple(r) for r in got.collect()) == [(10, "Prednisone 5 mg", "ketorolac"), (11, "Prednisone 5 mg", None)]
    assert not any("Aggregate" in line and "med_name" in line and "collect_set" not in line for line in _plan(got).splitlines())


def test_codes_of_history_flags_filter_the_events_before_any_exchange(spark):
    """Events with other codes are left out by a condition on their own table, below the joins."""
    tables = {
        "diagnosis_code": spark.createDataFrame([(1, "ICD-10-CM", "E78.5"), (2, "ICD-10-CM", "I25.10"), (3, "ICD-10-CM", "I10"), (4, "ICD-9-CM", "E78.5")],
                                                "diagnosis_key long, type string, value string"),
        "diagnosis_event": spark.createDataFrame([(1, 1), (1, 3), (2, 2), (2, 1), (3, 3), (4, 4), (9, 1), (None, 1), (1, None)], "patient_key long, diagnosis_key long")}
    base = spark.createDataFrame([(1,), (2,), (3,), (4,), (2,)], "patient_key long")
    got = registry.history_flags(tables, Cohort(base, "patient_key"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 0), (2, 1, 1)]
    assert any("Filter" in line and "getbit" in line and "diagnosis_key" in line for line in _plan(got).splitlines())


def test_results_of_a_case_meet_the_text_table_once(spark):
    """Texts for text families only; a stone needs a stone procedure and a comment, repeats and missing texts stay."""
    components = [(1, "Creatinine", "Chemistry", None), (2, "pH, urine", "Chemistry", None), (3, "Culture, Urine", "Chemistry", None), (4, "Final Diagnosis", "Surgical Pathology", None),
                  (5, "Margins", "Surgical Pathology", "Synoptic Checklist Question"), (6, "Calculi Composition", "Chemistry", None), (7, "Sodium", "Chemistry", None), (8, None, "Chemistry", None)]
    results = [(1, c, f"r{c}", 10, f"L{c}", f"v{c}", DAY(2001, 1, 1)) for c in range(1, 9)] + [(1, 6, "other", 11, "L9", "v", DAY(2001, 1, 1)), (1, 6, "silent", 10, "L9", "v", DAY(2001, 1, 1)), (1, 3, "bare", 10, "L9", "v", DAY(2001, 1, 1))]
    tables = {
        "lab_component": spark.createDataFrame(components, "component_key long, name string, type string, subtype string"),
        "lab_result": spark.createDataFrame(results, "patient_key long, component_key long, result_key string, procedure_key long, order_id string, value string, collected date").withColumn("resulted", F.col("collected")),
        "lab_text": spark.createDataFrame([(f"r{c}", f"t{c}", f"c{c}") for c in range(1, 9)] + [("r4", "again", None), ("other", "t", "c"), ("silent", "t", ""), ("unknown", "t", "c")], "result_key string, value string, comment string"),
        "procedure": spark.createDataFrame([(10, "STONE ANALYSIS"), (10, "Stone again"), (11, "CT ABDOMEN")], "procedure_key long, name string")}
    got = registry.case_labs(tables, Cohort(spark.createDataFrame([(1,)], "patient_key long"), "patient_key"))
    rows = sorted(((r.family, r.category, r.result_key, r.shown, r.order_id, r.resulted) for r in got.collect()), key=str)
    assert rows == sorted([
        ("lab", "creatinine", "r1", "v1", None, DAY(2001, 1, 1)), ("urine", "ph", "r2", "v2", None, None), ("culture", "culture", "r3", "t3   c3", None, None), ("culture", "culture", "bare", None, None, None),
        ("pathology", "final_report", "r4", "t4", "L4", None), ("pathology", "final_report", "r4", "again", "L4", None), ("synoptic", "Margins", "r5", "t5", "L5", None),
        ("stone", "composition", "r6", "c6", None, None)], key=str)


def test_later_days_sends_the_left_rows_once(spark):
    from wardflow.operators.intervals import later_days
    left = spark.range(500).selectExpr("id AS c", "id % 9 AS k", "DATE '2001-01-01' + CAST(id % 30 AS INT) AS d")
    right = spark.range(300).selectExpr("id % 9 AS k", "DATE '2001-01-01' + CAST(id % 31 AS INT) AS e")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = later_days(left, right, key="k", left_date="d", right_date="e", out="l")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2 and got.count() == 500


def test_case_rows_lie_by_patient_unless_patients_share_a_case(spark):
    """A case key of two patients is put together by case, as it was; repeated rows of one patient are no such case."""
    alone = spark.createDataFrame([(1, 10), (1, 10), (2, 11)], "patient_key long, case_key long")
    shared = spark.createDataFrame([(1, 10), (2, 10), (2, 11)], "patient_key long, case_key long")
    assert registry.case_keys(alone) == ["patient_key", "case_key"] and registry.case_keys(shared) == ["case_key"]
    parts = spark.createDataFrame([(1, 10, "a", None), (2, 10, "b", "c"), (2, 11, None, "d")], "patient_key long, case_key long, x string, y string")
    assert sorted(tuple(r) for r in registry.per_case(parts, ["case_key"]).collect()) == [(10, "b", "c"), (11, None, "d")]
    assert sorted(map(str, registry.per_case(parts, ["patient_key", "case_key"]).collect())) == sorted(map(str, parts.collect()))
