"""Report options that repeat the original behaviour."""

import pytest
from pyspark.sql import functions as F

from wardflow.plans import billing, cohort, datamart, rosters
from wardflow.session import tune
from wardflow.standins import Tables
from wardflow.standins.basics import RUN_DATE
from wardflow.standins.clinical import COHORT_DATE, clinical_tables
from wardflow.standins.revenue import ACTIVE_SINCE
from wardflow.standins.warehouse import revenue_tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(tune(spark), SF)


def test_unreduced_visits_keep_one_row_per_patient(tables):
    revenue = revenue_tables(tables)
    every = billing.billing_roster(revenue, RUN_DATE, visits_per_patient=False)
    assert every.count() == every.select("contact_id").distinct().count() > 0


def test_datamart_options(tables):
    t = clinical_tables(tables)
    wide = datamart.surgical_datamart(t, "SUPPLIER%", earlier_dx=True, expand_follow_up=True)
    base = datamart.base_population(t, "SUPPLIER%", performed_only=False)
    images = datamart.follow_up_imaging(t, base).groupBy("patient_key").count()
    want = base.join(images, "patient_key", "left").agg(F.sum(F.coalesce("count", F.lit(1)))).first()[0]
    assert wide.count() == want
    # The first admission of a patient has no earlier one.
    once = base.groupBy("patient_key").count().where("count = 1").select("patient_key")
    assert wide.join(once, "patient_key").where("readmission_dx is not null").count() < wide.count()


def test_undotted_codes_change_the_flags(tables):
    t = clinical_tables(tables)
    patients = tables.customer.select(F.col("c_custkey").alias("patient_key"))
    written = cohort.condition_flags(t, patients).agg(F.bit_or("mask")).first()[0]
    undotted = cohort.condition_flags(t, patients, "undotted").agg(F.bit_or("mask")).first()[0]
    assert written != undotted


def test_roster_case_rule(tables):
    revenue = revenue_tables(tables)
    loose = rosters.roster_members(revenue, ACTIVE_SINCE).count()
    strict = rosters.roster_members(revenue, ACTIVE_SINCE, ignore_case=False).count()
    assert 0 < strict <= loose


def test_parent_company_of_some_patients(tables, spark):
    some = spark.createDataFrame([(i,) for i in range(0, 200)], "patient_key long")
    got = rosters.parent_company(revenue_tables(tables), RUN_DATE, some)
    keys = {r.patient_key for r in got.select("patient_key").distinct().collect()}
    assert keys and max(keys) < 200


def test_cohort_of_one_surgeon(tables):
    got = cohort.comorbidity_cohort(clinical_tables(tables), COHORT_DATE, cohort.SHOULDER_CODES, surgeon_like="%000003")
    assert {r.surgeon_name for r in got.select("surgeon_name").distinct().collect()} == {"Supplier#000000003"}
