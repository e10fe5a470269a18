"""Charge extract with patient, guarantor, employer and three insurances."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import exactly_days_ago
from ..functions.text import split_name
from ..operators.aggregates import slot_pivot
from ..operators.joins import join_first_key, lookups

# Coverage line -> column prefix, and account class -> visit type.
SLOTS = {1: "primary", 2: "secondary", 3: "tertiary"}
VISIT_TYPES = {1: "I", 2: "O", 3: "E"}
INSURANCE = {
    "plan_code": "plan_id", "name": "plan_name", "address": "plan_address", "address_2": "plan_address_2", "city": "plan_city",
    "state": "plan_state", "zip": "plan_zip", "policy_number": "subscriber_number", "group_number": "group_number",
    "insured_name": "subscriber_name", "insured_dob": "subscriber_birth", "insured_relationship": "relation",
    "insured_gender": "member_sex",
}


def insurance_slots(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Primary, secondary and tertiary insurance of an account: the coverage list is joined once for all
    lines and then turned into columns."""
    accounts = tables["account"].select("account_id", F.col("patient_id").alias("_patient"))
    listed = tables["coverage_list"].where(F.col("line").isin(list(SLOTS))).join(accounts, "account_id")
    listed = listed.join(tables["coverage"], "coverage_id", "left").join(tables["plan"], "plan_id", "left")
    listed = lookups(listed, [(tables["state"], "plan_state_code", "code", {"plan_state": "abbr"})])
    member = tables["coverage_member"].withColumnsRenamed({"coverage_id": "_c", "patient_id": "_p"})
    listed = listed.join(member, (F.col("coverage_id") == F.col("_c")) & (F.col("_patient") == F.col("_p")), "left").drop("_c", "_p")
    listed = lookups(listed, [(tables["relation"], "relation_code", "code", {"relation": "name"}),
                              (tables["sex"], "member_sex_code", "code", {"member_sex": "abbr"})])
    return slot_pivot(listed, ["account_id"], "line", ["coverage_id"], INSURANCE, SLOTS)


def two_lines(addresses: DataFrame, key: str, prefix: str) -> DataFrame:
    return slot_pivot(addresses, [key], "line", ["address"], {"address": "address"}, {1: f"{prefix}1", 2: f"{prefix}2"})


def charge_extract(tables: Mapping[str, DataFrame], run_date: dt.date, filed_days_ago: int | None = 3,
                   destinations: list[int] | None = None, sources: list[int] | None = None,
                   flags: list[int] | None = None, legacy_name_split: bool = False) -> DataFrame:
    """One row per charge.  ``filed_days_ago=None`` takes charges of every filing day."""
    charge = tables["charge"]
    if filed_days_ago is not None:
        charge = charge.where(exactly_days_ago("filed_time", run_date, filed_days_ago))
    for column, wanted in (("destination", destinations), ("source", sources), ("system_flag", flags)):
        if wanted is not None:
            charge = charge.where(F.col(column).isin(wanted))

    patient_rows = lookups(tables["patient"], [
        (tables["state"], "state_code", "code", {"patient_state": "abbr"}),
        (tables["sex"], "sex_code", "code", {"patient_gender": "abbr"}),
        (tables["marital"], "marital_code", "code", {"patient_marital_status": "name"})])
    patient_rows = patient_rows.join(two_lines(tables["patient_address"], "patient_id", "home"), "patient_id", "left").select(
        "patient_id", F.col("last_name").alias("patient_last_name"), F.col("first_name").alias("patient_first_name"),
        F.col("home1_address").alias("patient_address"), F.col("home2_address").alias("patient_address_2"),
        F.col("city").alias("patient_city"), "patient_state", F.col("zip").alias("patient_zip"),
        F.to_date("birth_date").alias("patient_dob"), "patient_gender", "patient_marital_status")

    last, first = split_name("account_name", legacy_name_split)
    guarantor = lookups(tables["guarantor"], [
        (tables["state"], "state_code", "code", {"responsible_state": "abbr"}),
        (tables["employer"], "employer_id", "employer_id", {"employer_name": "employer_name", "_employer_state": "state_code"}),
        (tables["state"], "_employer_state", "code", {"employer_state": "abbr"})])
    guarantor = guarantor.join(two_lines(tables["guarantor_address"], "guarantor_id", "bill"), "guarantor_id", "left").select(
        "guarantor_id", last.alias("responsible_last_name"), first.alias("responsible_first_name"),
        F.col("bill1_address").alias("responsible_address"), F.col("bill2_address").alias("responsible_address_2"),
        F.col("city").alias("responsible_city"), "responsible_state", F.col("zip").alias("responsible_zip"),
        F.to_date("birth_date").alias("responsible_dob"), "employer_name", "employer_state")

    visit_type = F.create_map(*[F.lit(x) for kv in VISIT_TYPES.items() for x in kv])
    account = tables["account"].select(
        "account_id", F.to_date("admitted").alias("visit_admission_date"), F.to_date("discharged").alias("visit_discharge_date"),
        F.try_element_at(visit_type, F.col("class_code")).alias("visit_type"))
    provider = tables["provider"].select("provider_id", F.col("name").alias("referring_doctor"))
    rows = join_first_key(charge, provider, ["referring_id", "billing_id"], "provider_id").drop("provider_id")
    rows = (
        rows.join(account, "account_id", "left").join(insurance_slots(tables), "account_id", "left")
        .join(patient_rows, "patient_id", "left").join(guarantor, "guarantor_id", "left")
    )
    return rows.withColumn("visit_date_of_service", F.to_date("service_date")).drop(
        "filed_time", "service_date", "destination", "source", "system_flag", "referring_id", "billing_id")
