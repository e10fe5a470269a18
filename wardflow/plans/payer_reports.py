"""Census and discharge reports per payer and facility, written by one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import report_name, text_cell
from ..sinks import codepage, named

# Report column -> source column of the two layouts.
CENSUS = {"patient_name": "patient_name", "dob": "dob", "subscriber_number": "subscriber_number", "admit_date": "admission_date",
          "primary_dx": "primary_diagnosis", "admit_provider": "admitting_provider", "patient_class": "patient_class",
          "unit": "unit", "room_name": "room_name"}
DISCHARGE = {"mrn": "mrn", "patient_name": "patient_name", "dob": "dob", "subscriber_number": "subscriber_number",
             "authorization_number": "authorization_number", "patient_class": "patient_class", "admit_date": "admission_date",
             "discharge_date": "discharge_date", "disposition": "discharge_disposition", "los": "los", "service": "hospital_service"}
ON = ["location_id", "payer", "plan"]


def drivers(rows: DataFrame, active_only: bool = False) -> DataFrame:
    """Distinct (payer, facility, location, fax, plan) rows that each get a report."""
    kept = rows.where(F.col("active") == 1) if active_only else rows
    return kept.select("payer", "facility", "location_id", "fax", "plan").distinct()


def report_file(template: str, at) -> Column:
    """Name of the report of a driver row."""
    part = F.concat_ws("_", *[F.regexp_replace(c, r"[ /\\,]", "") for c in ("payer", "facility", "plan")])
    return report_name(template, at, part)


def report_rows(data: DataFrame, driver: DataFrame, layout: dict[str, str], template: str, at) -> DataFrame:
    """Rows of every report with their file name; one join replaces the loop over payers and facilities."""
    joined = data.join(driver, ON)
    return joined.select(
        report_file(template, at).alias("file_name"), "payer", "facility", "plan",
        text_cell("hospital_account").alias("hospital_account"), *[F.col(src).alias(out) for out, src in layout.items()])


def report_counts(data: DataFrame, driver: DataFrame) -> DataFrame:
    """Rows per report, zero included; data is counted before it meets the driver list."""
    counts = data.groupBy(*ON).agg(F.count(F.lit(1)).alias("n_rows"))
    return driver.join(counts, ON, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))


def write_reports(data: DataFrame, driver: DataFrame, layout: dict[str, str], template: str, at, path: str, sep: str = ",",
                  encoding: str | None = None) -> DataFrame:
    """One file for every driver row, under its exact name, rows by account; return the log of names, rows and bytes.

    All files come from one job and appear together.  A driver without rows has a file with the header only; drivers that
    differ in nothing but the fax number share one.
    """
    distinct = driver.dropDuplicates(["payer", "facility", "location_id", "plan"])
    rows = report_rows(data, distinct, layout, template, at).drop("payer", "facility", "plan")
    columns = [c for c in rows.columns if c != "file_name"]
    lines = codepage.with_lines(rows, columns, sep, False, encoding, "_line")
    return named.write_named(lines, path, F.col("_line"), columns, codepage.header_bytes(columns, sep, False, encoding),
                             distinct.select(report_file(template, at).alias("file_name")))
