"""Clinical category maps: lab components, modalities, medication classes, ASA score, kidney status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import col
from .text import like_any

# Component -> case-insensitive name patterns; the first match wins.
LABS = {"hemoglobin": ["%Hemoglobin%"], "bun": ["%BUN"], "creatinine": ["Creatinine"], "egfr": ["%eGFR%"]}
URINE = {
    "clarity": ["Clarity%urine%"], "glucose": ["Glucose%urine%"], "ketones": ["Ketones%urine%"], "ph": ["pH%urine%"],
    "blood": ["Blood%urine%"], "nitrites": ["Nitrites%urine%"], "leukocyte_esterase": ["Leukocyte%Esterase%urine%"],
    "protein": ["Protein%urine%"], "bilirubin": ["Bilirubin%urine%"], "urobilinogen": ["Urobilinogen%urine%"],
    "specific_gravity": ["Specific%Gravity%urine%"], "rbcs": ["RBC%urine%"], "wbcs": ["WBC%urine%"],
    "bacteria": ["Bacteria%urine%"], "squamous_cells": ["Squamous%Epithelial%Cells%urine%"], "crystals": ["Crystals%urine%"],
    "hyaline_casts": ["Hyaline%Casts%urine%"], "mucus": ["Mucus%urine%"],
}
CULTURE = {"culture": ["%CULTURE%URINE", "%URINE%CULTURE"]}
STONE = {"composition": ["Calculi%Composition%"], "description": ["Calculi%Description%"]}
STONE_PROCEDURE = "%STONE%"
PATHOLOGY = {"Case Report": "case_report", "Final Diagnosis": "final_report"}
PATHOLOGY_TYPE = "%Pathology%"
SYNOPTIC = "Synoptic Checklist Question"
FOLLOWUP_LABS = ["bun", "creatinine", "egfr"]
MODALITIES = {"mri": ["mr%"], "xray": ["xr%", "xray%"], "ct": ["ct%"], "dexa": ["dxa%"], "ultrasound": ["us%"]}
CT_OR_MR = {"ct": ["ct%"], "mri": ["mr%"]}
STEROIDS = ["%PREDNISONE%", "%METHYLPREDNISOLONE%", "%DEXAMETHASONE%", "%HYDROCORTISONE%", "%PREDNISOLONE%", "%TRIAMCINOLONE%"]
NSAIDS = ["%IBUPROFEN%", "%NAPROXEN%", "%KETOROLAC%", "%MELOXICAM%", "%CELECOXIB%", "%DICLOFENAC%", "%INDOMETHACIN%"]
ASA = {
    "HEALTHY": 1, "MILD SYSTEMIC DISEASE": 2, "SEVERE SYSTEMIC DISEASE": 3, "INCAPACITATING DISEASE": 4,
    "SEVERE SYSTEMIC DISEASE THAT IS A CONSTANT THREAT TO LIFE": 4, "MORBUND": 5, "BRAIN DEAD": 6,
}
SOLITARY_KIDNEY = {
    "Renal agenesis, unilateralQ": ["Q60%"], "Acquired absence of kidney": ["Z90%"],
    "Acquired absence of other specified parts of urinary track": ["Z90.49%"],
    "Other specified disorders of kidney and ureter": ["N28.89%"], "Kidney transplant status": ["Z94.0%"],
}


def first_match(c, table: dict[str, list[str]]) -> Column:
    """Name of the first entry with a matching pattern; NULL when none."""
    out = None
    for name, patterns in table.items():
        hit = like_any(c, patterns)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def asa_score(c) -> Column:
    """ASA rating text to 1..6; sentinel labels and unknown texts give NULL."""
    scores = F.create_map(*[F.lit(x) for kv in ASA.items() for x in kv])
    return F.try_element_at(scores, F.upper(F.trim(col(c))))


def medication_class(name, generic) -> Column:
    """Steroid patterns win over NSAID patterns, in either name."""
    n, g = F.coalesce(col(name), F.lit("")), F.coalesce(col(generic), F.lit(""))
    return F.when(like_any(n, STEROIDS) | like_any(g, STEROIDS), "STEROID").when(
        like_any(n, NSAIDS) | like_any(g, NSAIDS), "NSAID")


def bmi_flag(bmi) -> Column:
    return F.when(col(bmi).isNull(), "Unknown").when(col(bmi) >= 30, "Yes").otherwise("No")
