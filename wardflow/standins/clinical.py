"""Registry, comorbidity cohort and data mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import clinical as cat, conditions
from ..plans import cohort, datamart, registry
from ..session import materialise
from . import LazyTables, Tables, query
from .warehouse import REVENUE_SQL, choice, patient, provider, sql_choice

COHORT_DATE = dt.date(2001, 8, 2)
COMPONENTS = [
    "Hemoglobin A1c", "Serum BUN", "Creatinine", "eGFR cr", "BUN/Creat ratio", "Clarity, urine", "Glucose, urine", "Ketones, urine",
    "pH, urine", "Blood, urine", "Nitrites, urine", "Leukocyte Esterase, urine", "Protein, urine", "Bilirubin, urine",
    "Urobilinogen, urine", "Specific Gravity, urine", "RBCs, urine", "WBCs, urine", "Bacteria, urine", "Squamous Epithelial Cells, urine",
    "Crystals, urine", "Hyaline Casts, urine", "Mucus, urine", "Culture, Urine", "Case Report", "Final Diagnosis", "Tumor Site", "Margins",
    "Calculi Composition", "Calculi Description", "Sodium"]
PATH_NAMES = ["Case Report", "Final Diagnosis", "Tumor Site", "Margins"]
PROCEDURES = ["STONE ANALYSIS", "CT ABDOMEN", "MR PELVIS", "XR CHEST", "US RENAL", "DXA HIP"]
CODES = ["I50.9", "E11.9", "E11.21", "G47.33", "G4733", "428.0", "I10", "F32.1", "F32.4", "J44.1", "D68.9", "E78.5", "I25.10", "N18.3",
         "C61", "C64.1", "K70.30", "K75.4", "Z94.4", "I21.4", "I48.0", "F41.1", "G30.9", "G81.90", "R53.2", "R532", "Z74.1", "O10.111",
         "O11.4", "E66.9", "M05.1", "B20", "D50.0", "T82.817A", "305.2", "K25.9", "Z95.2", "I34.0", "E44.0", "R63.4", "F10.20", "D63.1"]
DISPLAYS = ["Obstructive sleep apnea", "Other finding", "Screening", "Central Sleep Apnea", "Follow up", "Pain", "Cough"]
MED_NAMES = ["Prednisone 5 mg", "Ibuprofen 200", "Lisinopril", None, "Celecoxib and Dexamethasone", "NAPROXEN sodium", None]
GENERICS = ["prednisone", "ibuprofen", "lisinopril", "ketorolac", "hydrocortisone"]
CPTS = ["29806", "23455", "99213", "29828", "23430", "99214", "29827", "12345"]


def hours(c, n):
    return F.col(c) + F.make_dt_interval(hours=n if isinstance(n, F.Column) else F.lit(n))


def surgical_case(t: Tables):
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    rating = F.when(F.col("o_orderpriority") == "1-URGENT", "Morbund").when(F.col("o_orderpriority") == "2-HIGH", " severe systemic disease").when(
        F.col("o_orderpriority") == "3-MEDIUM", "Mild systemic disease").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "*Unspecified").otherwise("Healthy")
    discharge = F.date_add(day, (k % 3).cast("int") + 2)
    return t.orders.select(
        k.alias("case_key"), F.concat(F.lit("C"), k.cast("string")).alias("case_id"), F.col("o_custkey").alias("patient_key"),
        k.alias("encounter_key"), (k % 10).alias("surgeon_key"), (k % 10).alias("procedure_key"), (F.col("o_custkey") % 25).alias("location_key"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("surgery_date_key"), day.alias("surgery_date"),
        F.date_sub(day, F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("admission_date"), discharge.alias("discharge_date"),
        hours("o_orderdate", 7).alias("admission_instant"), discharge.cast("timestamp_ntz").alias("discharge_instant"),
        hours("o_orderdate", 8).alias("procedure_start"),
        F.when(F.col("o_totalprice") >= 4000, hours("o_orderdate", 10)).alias("procedure_complete"), rating.alias("asa_rating"),
        F.when(F.col("o_totalprice") < 2000, 1).otherwise(0).alias("canceled"),
        F.when(F.col("o_totalprice") > 490000, "Refused").otherwise("").alias("reason_not_performed"), F.col("o_totalprice").alias("total_cost"))


def patient_lines(t: Tables):
    return t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).withColumns({
        "patient_key": F.col("o_custkey"), "at": hours("l_shipdate", F.col("l_linenumber")),
        "line_key": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")})


def dimension(t: Tables, name: str, df):
    """A dimension as a table of its own.  Left as an expression of its key, filters on its names would be
    inferred for the key of the facts and worked out for every fact row."""
    return materialise(t.spark, df, name)


def clinical_tables(t: Tables) -> LazyTables:
    pk, ck = F.col("p_partkey"), F.col("c_custkey")
    lines = patient_lines(t)
    labs, images = lines.where("l_linestatus = 'O'"), lines.where("l_linestatus = 'F'")
    day = F.to_date("o_orderdate")
    name = choice(pk, COMPONENTS)
    then = F.col("ts") - F.expr("INTERVAL 24 YEARS")
    key = F.date_format("l_shipdate", "yyyyMMdd").cast("int")
    return LazyTables({
        "surgical_case": lambda: surgical_case(t), "provider": lambda: provider(t), "patient": lambda: patient(t),
        "procedure": lambda: dimension(t, "procedure", t.supplier.select(F.col("s_suppkey").alias("procedure_key"), choice(F.col("s_suppkey"), PROCEDURES).alias("name"))),
        "location": lambda: t.nation.select(F.col("n_nationkey").cast("long").alias("location_key"), F.col("n_name").alias("name")),
        "vitals": lambda: t.events.select(F.col("user_id").alias("patient_key"), then.alias("recorded"), F.col("value").alias("bmi"),
                                  (F.col("event_id") % 50 + 150).alias("height"), (F.col("event_id") % 70 + 50).alias("weight")),
        "diagnosis_list": lambda: t.customer.select(
            ck.alias("patient_key"), F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("type_1_diabetes"),
            F.when(F.col("c_mktsegment") == "FURNITURE", 1).otherwise(0).alias("type_2_diabetes"),
            F.when(F.col("c_nationkey") < 9, 1).otherwise(0).alias("hypertension")),
        "social_history": lambda: t.orders.select(
            F.concat(F.lit("E"), F.col("o_custkey").cast("string")).alias("patient_id"), F.col("o_orderdate").alias("contact_date"),
            choice(F.col("o_orderkey"), ["Never", "Former", "Every Day"]).alias("smoking"), F.col("o_orderpriority").alias("smokeless")),
        "diagnosis_event": lambda: lines.select(
            "patient_key", F.col("l_partkey").alias("diagnosis_key"), F.lit(1).alias("count"),
            F.when(F.col("l_returnflag") == "R", "Billing").otherwise("Encounter Diagnosis").alias("type")),
        "diagnosis_code": lambda: dimension(t, "diagnosis_code", t.part.select(
            pk.alias("diagnosis_key"), F.when(F.col("p_size") > 10, "ICD-10-CM").otherwise("ICD-9-CM").alias("type"),
            choice(pk, CODES).alias("value"), choice(pk, DISPLAYS).alias("display"))),
        "diagnosis": lambda: t.part.select(pk.alias("diagnosis_key"), F.col("p_name").alias("name")),
        "admission": lambda: t.orders.select(
            F.col("o_orderkey").alias("admission_key"), F.col("o_custkey").alias("patient_key"), day.alias("admission_date"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey") % 200).alias("principal_problem_key"),
            F.when(F.col("o_orderstatus") == "F", "Confirmed").when(F.col("o_orderstatus") == "O", "Pending").otherwise("Canceled").alias("confirmation_status")),
        "clinical_note": lambda: t.orders.select(
            F.col("o_custkey").alias("patient_key"), day.alias("service_date"),
            F.when(F.col("o_orderpriority") == "5-LOW", "Progress").otherwise("Op Note").alias("type"),
            F.when(F.col("o_orderstatus") == "F", "Draft").otherwise("Signed").alias("status"), F.lit("Urology").alias("service"),
            hours("o_orderdate", (F.col("o_orderkey") % 24).cast("int")).alias("last_edited"),
            F.concat(F.lit("note "), F.col("o_orderkey").cast("string")).alias("text")),
        "lab_result": lambda: labs.select(
            "patient_key", F.col("l_partkey").alias("component_key"), F.col("line_key").alias("result_key"), F.col("l_suppkey").alias("procedure_key"),
            F.concat(F.lit("L"), F.col("l_orderkey").cast("string")).alias("order_id"), F.col("l_quantity").cast("int").cast("string").alias("value"),
            F.col("at").alias("collected"), hours("at", 24).alias("resulted")),
        "lab_component": lambda: dimension(t, "lab_component", t.part.select(
            pk.alias("component_key"), name.alias("name"), F.when(name.isin(PATH_NAMES), "Surgical Pathology").otherwise("Chemistry").alias("type"),
            F.when(name.isin("Tumor Site", "Margins"), "Synoptic Checklist Question").alias("subtype"))),
        "lab_text": lambda: labs.select(
            F.col("line_key").alias("result_key"), F.when(F.col("l_returnflag") != "A", F.concat(F.lit("T"), F.col("l_partkey").cast("string"))).alias("value"),
            F.when(F.col("l_returnflag") == "N", "").otherwise(F.concat(F.lit("C"), F.col("l_suppkey").cast("string"))).alias("comment")),
        "imaging": lambda: images.select(
            "patient_key", F.col("line_key").alias("imaging_key"), F.col("l_suppkey").alias("procedure_key"), F.col("at").alias("exam_start"),
            F.concat(F.lit("N"), F.col("l_partkey").cast("string")).alias("narrative"),
            F.when(F.col("l_returnflag") != "R", F.concat(F.lit("I"), F.col("l_partkey").cast("string"))).alias("impression")),
        "cancer_staging": lambda: t.customer.select(
            ck.alias("patient_key"), choice(ck, ["Stage I", "Stage II", None]).alias("stage_description"), choice(ck, ["G1", "G2"]).alias("histologic_grade"),
            (ck % 60).alias("tumor_size_mm"), choice(ck, ["R0", "R1"]).alias("residual_tumor"), choice(ck, ["Absent", "Present"]).alias("lymph_vascular_invasion"),
            choice(ck, ["L0", "L1", None]).alias("lymphatic_invasion")),
        "medication": lambda: dimension(t, "medication", t.part.select(pk.alias("medication_key"), choice(pk, MED_NAMES).alias("name"), choice(pk, GENERICS).alias("generic_name"),
                                    F.col("p_type").alias("pharmaceutical_class"))),
        "medication_event": lambda: lines.select(
            "patient_key", F.col("l_partkey").alias("medication_key"), F.to_date("l_shipdate").alias("start_date"), key.alias("start_date_key"),
            F.when(F.col("l_returnflag") == "A", 0).otherwise(key + 1).alias("end_date_key")),
        "case_code": lambda: t.lineitem.select(F.concat(F.lit("C"), F.col("l_orderkey").cast("string")).alias("case_id"), F.col("l_partkey").alias("procedure_id")),
        "procedure_code": lambda: dimension(t, "procedure_code", t.part.select(pk.alias("procedure_id"), choice(pk, CPTS).alias("cpt"), F.col("p_name").alias("procedure_name"))),
        "billing_account": lambda: t.orders.select(
            F.col("o_orderkey").alias("account_key"), F.col("o_orderkey").alias("encounter_key"), F.col("o_orderpriority").alias("financial_class"),
            day.alias("admission_date"), F.date_add(day, 5).alias("discharge_date"), F.lit(5).alias("los_days")),
        "encounter": lambda: t.orders.select(F.col("o_orderkey").alias("encounter_key"), (F.col("o_orderkey") % 200).alias("primary_diagnosis_key")),
        "social_determinant": lambda: t.lineitem.select(
            F.col("l_orderkey").alias("encounter_key"), choice(F.col("l_linenumber"), ["Food", "Housing", "Transport"]).alias("domain"),
            F.col("l_returnflag").alias("concern"), F.col("l_linestatus").alias("interpretation")),
        "risk": lambda: t.customer.select(ck.alias("patient_key"), (ck % 9).alias("charlson"), choice(ck, ["Independent", "Assisted", None]).alias("functional_status"),
                                  (F.col("c_nationkey") * 10).alias("days_since_admission")),
        "supply_use": lambda: t.lineitem.select(F.col("l_orderkey").alias("case_key"), F.col("l_suppkey").alias("supply_key"),
                                        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("count")),
        "supply": lambda: t.supplier.select(F.col("s_suppkey").alias("supply_key"), F.lit(1).alias("is_current"),
                                    choice(F.col("s_suppkey"), ["Bone Implant", "Drape", "IMPLANT screw"]).alias("type"), F.col("s_name").alias("name")),
        "ed_visit": lambda: t.events.select(F.col("user_id").alias("patient_key"), F.to_date(then).alias("arrival_date"), F.col("event_type").alias("reason")),
    })


# ---------------------------------------------------------------- oracle SQL

def _first_match(column: str, table: dict) -> str:
    return "CASE " + " ".join(
        f"WHEN {' OR '.join(f'{column} ILIKE {chr(39)}{p}{chr(39)}' for p in ps)} THEN '{n}'" for n, ps in table.items()) + " END"


_CLINICAL_SQL = f"""{REVENUE_SQL},
plines AS (SELECT l.*, o.o_custkey AS patient_key, l.l_shipdate + l.l_linenumber * INTERVAL 1 HOUR AS moment,
   concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS line_key FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
cases AS (SELECT o_orderkey AS case_key, o_custkey AS patient_key, o_orderkey % 10 AS procedure_key, CAST(o_orderdate AS DATE) AS surgery_date,
   CAST(o_orderdate AS DATE) - CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS admission_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 + 2 AS INTEGER) AS discharge_date,
   o_orderdate + INTERVAL 8 HOUR AS start_at, CASE WHEN o_totalprice >= 4000 THEN o_orderdate + INTERVAL 10 HOUR END AS end_at, o_totalprice,
   CASE o_orderpriority WHEN '1-URGENT' THEN 'Morbund' WHEN '2-HIGH' THEN ' severe systemic disease' WHEN '3-MEDIUM' THEN 'Mild systemic disease'
     WHEN '4-NOT SPECIFIED' THEN '*Unspecified' ELSE 'Healthy' END AS asa_rating, o_orderpriority FROM orders),
code AS (SELECT p_partkey AS k, {sql_choice('p_partkey', CODES)} AS value, {sql_choice('p_partkey', DISPLAYS)} AS display, p_size FROM part),
hist AS (SELECT l.patient_key, max(CASE WHEN c.value LIKE 'E78.%' THEN 1 ELSE 0 END) AS hyperlipidemia, max(CASE WHEN c.value LIKE 'I25.%' THEN 1 ELSE 0 END) AS coronary_artery_disease
  FROM plines l JOIN code c ON c.k = l.l_partkey AND c.p_size > 10 GROUP BY l.patient_key),
vital AS (SELECT user_id AS patient_key, ts - INTERVAL 24 YEARS AS recorded, value AS bmi, event_id % 50 + 150 AS height, event_id % 70 + 50 AS weight FROM events),
last_vital AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_key ORDER BY recorded DESC, bmi DESC, height DESC, weight DESC) AS rn FROM vital) WHERE rn = 1),
social AS (SELECT * FROM (SELECT o_custkey AS patient_key, {sql_choice('o_orderkey', ["Never", "Former", "Every Day"])} AS smoking, o_orderpriority AS smokeless,
   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, {sql_choice('o_orderkey', ["Never", "Former", "Every Day"])} DESC, o_orderpriority DESC) AS rn FROM orders) WHERE rn = 1),
proc AS (SELECT s_suppkey AS k, {sql_choice('s_suppkey', PROCEDURES)} AS name FROM supplier),
adm AS (SELECT o_orderkey AS k, o_custkey AS patient_key, CAST(o_orderdate AS DATE) AS day, p.p_name AS dx,
   CASE o_orderstatus WHEN 'F' THEN 'Confirmed' WHEN 'O' THEN 'Pending' ELSE 'Canceled' END AS status, o_orderpriority <> '5-LOW' AS has_dx, p.p_size
  FROM orders LEFT JOIN part p ON p.p_partkey = o_orderkey % 200 AND o_orderpriority <> '5-LOW'),
img AS (SELECT l.patient_key, l.line_key, l.moment, p.name, 'N' || CAST(l.l_partkey AS VARCHAR) AS narrative, CASE WHEN l.l_returnflag <> 'R' THEN 'I' || CAST(l.l_partkey AS VARCHAR) END AS impression
  FROM plines l JOIN proc p ON p.k = l.l_suppkey WHERE l.l_linestatus = 'F'),
base AS (SELECT c.*, p.mrn, p.age_in_years, p.sex, p.race, p.ethnicity, pr.name AS procedure_name, v.bmi, v.height, v.weight, s.smoking, s.smokeless,
   CAST(date_diff('day', c.surgery_date, c.discharge_date) AS INTEGER) AS los, CASE WHEN c.end_at IS NOT NULL THEN CAST(date_diff('day', c.surgery_date, c.discharge_date) AS INTEGER) END AS post_op_los,
   CASE WHEN cu.c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 1 ELSE 0 END AS diabetes_mellitus, CASE WHEN cu.c_nationkey < 9 THEN 1 ELSE 0 END AS hypertension
  FROM cases c JOIN patient p ON p.patient_key = c.patient_key AND p.is_current = 1 AND p.test = 0 JOIN customer cu ON cu.c_custkey = c.patient_key
  JOIN supplier sg ON sg.s_suppkey = c.case_key % 10
  LEFT JOIN proc pr ON pr.k = c.procedure_key LEFT JOIN last_vital v ON v.patient_key = c.patient_key LEFT JOIN social s ON s.patient_key = c.patient_key
  WHERE c.case_key > 0 AND c.o_totalprice >= 2000 AND c.o_totalprice <= 490000)"""


def _registry_sql() -> str:
    fam = ["lab", "urine"]
    comps = [(f, c) for f, tb in (("lab", cat.LABS), ("urine", cat.URINE)) for c in tb]

    def pivot(alias, tag):
        return ", ".join(f"max(CASE WHEN family = '{f}' AND category = '{c}' THEN shown END) AS {'' if f == 'lab' else 'urine_'}{c}_{tag}" for f, c in comps)
    path = ", ".join(f"'{p}'" for p in PATH_NAMES)
    follow = ", ".join(f"max(CASE WHEN category = '{c}' AND bucket = '{b}' THEN shown END) AS {c}_{b}" for b in ("w1", "m1", "m3", "m6", "y1", "ygt1") for c in cat.FOLLOWUP_LABS)
    dates = ", ".join(f"max(CASE WHEN category = '{c}' AND bucket = 'ygt1' THEN resulted END) AS {c}_ygt1_date" for c in cat.FOLLOWUP_LABS)

    def image(tag, op, time, direction):
        cols = ", ".join(f"max(CASE WHEN m = '{m}' THEN {s} END) AS {tag}_{m}_{n}" for m in ("ct", "mri") for s, n in (("moment", "date"), ("narrative", "result"), ("impression", "impression")))
        return f"""{tag}_img AS (SELECT case_key, {cols} FROM (SELECT b.case_key, CASE WHEN i.name ILIKE 'ct%' THEN 'ct' ELSE 'mri' END AS m, i.moment, i.narrative, i.impression,
   row_number() OVER (PARTITION BY b.case_key, CASE WHEN i.name ILIKE 'ct%' THEN 'ct' ELSE 'mri' END ORDER BY i.moment {direction}, i.line_key {direction}) AS rn
  FROM reg b JOIN img i ON i.patient_key = b.patient_key AND i.moment {op} b.{time} WHERE i.name ILIKE 'ct%' OR i.name ILIKE 'mr%') WHERE rn = 1 GROUP BY case_key)"""

    def first(name, family, category, cond, value, out):
        return f"""{name} AS (SELECT case_key, {value} AS {out}, order_id FROM (SELECT b.case_key, l.*, row_number() OVER (PARTITION BY b.case_key ORDER BY l.moment, l.line_key) AS rn
  FROM reg b JOIN lab l ON l.patient_key = b.patient_key AND l.family = '{family}' AND l.category = '{category}' AND {cond}) WHERE rn = 1)"""
    return f"""WITH {_CLINICAL_SQL},
comp AS (SELECT p_partkey AS k, {sql_choice('p_partkey', COMPONENTS)} AS name FROM part),
fam AS (SELECT k, name, 'lab' AS family, {_first_match('name', cat.LABS)} AS category FROM comp UNION ALL SELECT k, name, 'urine', {_first_match('name', cat.URINE)} FROM comp
  UNION ALL SELECT k, name, 'culture', CASE WHEN name ILIKE '%culture%urine' OR name ILIKE '%urine%culture' THEN 'culture' END FROM comp
  UNION ALL SELECT k, name, 'stone', CASE WHEN name ILIKE 'calculi%composition%' THEN 'composition' WHEN name ILIKE 'calculi%description%' THEN 'description' END FROM comp
  UNION ALL SELECT k, name, 'pathology', CASE name WHEN 'Case Report' THEN 'case_report' WHEN 'Final Diagnosis' THEN 'final_report' END FROM comp
  UNION ALL SELECT k, name, 'synoptic', CASE WHEN name IN ('Tumor Site', 'Margins') THEN name END FROM comp),
lab AS (SELECT l.patient_key, l.line_key, l.moment, l.moment + INTERVAL 24 HOUR AS resulted, 'L' || CAST(l.l_orderkey AS VARCHAR) AS order_id, f.family, f.category,
   CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS value, CASE WHEN l.l_returnflag <> 'A' THEN 'T' || CAST(l.l_partkey AS VARCHAR) END AS txt,
   CASE WHEN l.l_returnflag = 'N' THEN '' ELSE 'C' || CAST(l.l_suppkey AS VARCHAR) END AS comment, p.name AS proc_name
  FROM plines l JOIN fam f ON f.k = l.l_partkey AND f.category IS NOT NULL JOIN proc p ON p.k = l.l_suppkey WHERE l.l_linestatus = 'O'),
reg AS (SELECT * FROM base WHERE end_at IS NOT NULL),
shown AS (SELECT *, CASE WHEN family = 'culture' THEN txt || '   ' || comment ELSE value END AS shown FROM lab WHERE family IN ('lab', 'urine', 'culture')),
pre AS (SELECT case_key, {pivot('', 'pre_op')}, max(CASE WHEN family = 'culture' THEN shown END) AS urine_culture_pre_op FROM (SELECT b.case_key, l.family, l.category, l.shown,
    row_number() OVER (PARTITION BY b.case_key, l.family, l.category ORDER BY l.moment DESC, l.line_key DESC) AS rn FROM reg b JOIN shown l ON l.patient_key = b.patient_key AND l.moment <= b.start_at) WHERE rn = 1 GROUP BY case_key),
post AS (SELECT case_key, {pivot('', 'post_op')} FROM (SELECT b.case_key, l.family, l.category, l.shown,
    row_number() OVER (PARTITION BY b.case_key, l.family, l.category ORDER BY l.moment, l.line_key) AS rn FROM reg b JOIN shown l ON l.patient_key = b.patient_key AND l.moment >= b.end_at
    WHERE l.family <> 'culture') WHERE rn = 1 GROUP BY case_key),
fu AS (SELECT case_key, {follow}, {dates} FROM (SELECT *, row_number() OVER (PARTITION BY case_key, category, bucket ORDER BY moment DESC, line_key DESC) AS rn FROM
   (SELECT b.case_key, l.category, l.value AS shown, l.moment, l.resulted, l.line_key, CASE WHEN date_diff('day', date_trunc('week', b.end_at), date_trunc('week', l.moment)) = 7 THEN 'w1'
     WHEN date_diff('month', b.end_at, l.moment) = 1 THEN 'm1' WHEN date_diff('month', b.end_at, l.moment) = 3 THEN 'm3' WHEN date_diff('month', b.end_at, l.moment) = 6 THEN 'm6'
     WHEN date_diff('year', b.end_at, l.moment) = 1 THEN 'y1' WHEN date_diff('year', b.end_at, l.moment) >= 1 THEN 'ygt1' END AS bucket
    FROM reg b JOIN lab l ON l.patient_key = b.patient_key AND l.moment >= b.end_at AND l.family = 'lab' AND l.category <> 'hemoglobin') WHERE bucket IS NOT NULL) WHERE rn = 1 GROUP BY case_key),
note AS (SELECT patient_key, day, text FROM (SELECT o_custkey AS patient_key, CAST(o_orderdate AS DATE) AS day, 'note ' || CAST(o_orderkey AS VARCHAR) AS text,
    row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey % 24 DESC, 'note ' || CAST(o_orderkey AS VARCHAR) DESC) AS rn FROM orders
   WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F') WHERE rn = 1),
later AS (SELECT b.case_key, a.* FROM reg b JOIN adm a ON a.patient_key = b.patient_key AND a.day > b.discharge_date),
rdates AS (SELECT case_key, string_agg(strftime(day, '%m/%d/%Y'), ',' ORDER BY day DESC) AS readmission_dates FROM (SELECT DISTINCT case_key, day FROM later) GROUP BY case_key),
rdx AS (SELECT case_key, string_agg(dx, ',' ORDER BY day DESC, dx DESC) AS readmission_reasons FROM (SELECT case_key, dx, max(day) AS day FROM later WHERE dx IS NOT NULL GROUP BY ALL) GROUP BY case_key),
rstat AS (SELECT case_key, status AS readmission_status FROM (SELECT *, row_number() OVER (PARTITION BY case_key ORDER BY day DESC, k DESC) AS rn FROM later) WHERE rn = 1),
{first('path_case', 'pathology', 'case_report', 'CAST(l.moment AS DATE) >= b.surgery_date', 'txt', 'pathology_case_report')},
{first('path_final', 'pathology', 'final_report', 'CAST(l.moment AS DATE) >= b.surgery_date', 'txt', 'pathology_final_report')},
{first('stone_c', 'stone', 'composition', "l.moment >= b.start_at AND l.proc_name = 'STONE ANALYSIS' AND length(l.comment) > 0", 'comment', 'calculi_composition')},
{first('stone_d', 'stone', 'description', "l.moment >= b.start_at AND l.proc_name = 'STONE ANALYSIS' AND length(l.comment) > 0", 'comment', 'calculi_description')},
syn AS (SELECT case_key, string_agg(category || '==' || txt, ',' ORDER BY moment DESC, category || '==' || txt DESC) AS synoptic_report FROM (SELECT b.case_key, l.category, l.txt, l.moment,
    row_number() OVER (PARTITION BY b.case_key, l.category ORDER BY l.moment, l.line_key) AS rn FROM reg b JOIN path_final f ON f.case_key = b.case_key
    JOIN lab l ON l.patient_key = b.patient_key AND l.family = 'synoptic' AND l.order_id = f.order_id AND l.txt IS NOT NULL AND date_diff('minute', b.start_at, l.moment) >= 1) WHERE rn = 1 GROUP BY case_key),
{image('pre_op', '<=', 'start_at', 'DESC')},
{image('post_op', '>=', 'end_at', 'ASC')}
SELECT b.case_key, b.mrn, b.age_in_years AS age, b.sex, b.race, b.ethnicity, b.height, b.weight, b.bmi, b.asa_rating, b.diabetes_mellitus, b.hypertension,
  coalesce(h.hyperlipidemia, 0) AS hyperlipidemia, coalesce(h.coronary_artery_disease, 0) AS coronary_artery_disease, b.smoking, b.smokeless,
  CAST(b.admission_date AS VARCHAR) AS admission_date, CAST(b.surgery_date AS VARCHAR) AS surgery_date, CAST(b.discharge_date AS VARCHAR) AS discharge_date, b.procedure_name, b.los, b.post_op_los,
  readmission_dates, readmission_reasons, readmission_status, pre.* EXCLUDE (case_key), post.* EXCLUDE (case_key), note.text AS op_note, fu.* EXCLUDE (case_key),
  pathology_case_report, pathology_final_report, synoptic_report, calculi_composition, calculi_description, pre_op_img.* EXCLUDE (case_key), post_op_img.* EXCLUDE (case_key)
FROM reg b LEFT JOIN hist h ON h.patient_key = b.patient_key LEFT JOIN rdates ON rdates.case_key = b.case_key LEFT JOIN rdx ON rdx.case_key = b.case_key
LEFT JOIN rstat ON rstat.case_key = b.case_key LEFT JOIN pre ON pre.case_key = b.case_key LEFT JOIN post ON post.case_key = b.case_key
LEFT JOIN note ON note.patient_key = b.patient_key AND note.day = b.surgery_date LEFT JOIN fu ON fu.case_key = b.case_key
LEFT JOIN path_case ON path_case.case_key = b.case_key LEFT JOIN path_final ON path_final.case_key = b.case_key LEFT JOIN syn ON syn.case_key = b.case_key
LEFT JOIN stone_c ON stone_c.case_key = b.case_key LEFT JOIN stone_d ON stone_d.case_key = b.case_key LEFT JOIN pre_op_img ON pre_op_img.case_key = b.case_key
LEFT JOIN post_op_img ON post_op_img.case_key = b.case_key"""


@query("registry_wide", _registry_sql())
def registry_wide(t: Tables):
    return registry.surgical_registry(clinical_tables(t), "SUPPLIER%")


_PATTERNS = ", ".join(f"('{flag}', '{kind}', '{text}')" for flag, kind, text in conditions.pattern_rows(conditions.COMORBIDITY, conditions.PATIENT))
_FLAGS_SQL = f"""pattern(flag, kind, text) AS (VALUES {_PATTERNS}),
hit AS (SELECT c.k, p.flag FROM code c JOIN pattern p ON c.value = p.text OR (p.kind = 'prefix' AND starts_with(c.value, p.text))
  UNION SELECT c.k, 'osa_flag' FROM code c WHERE c.display ILIKE '%sleep apnea%'),
flags AS (SELECT l.patient_key, {", ".join(f"max(CASE WHEN h.flag = '{f}' THEN 1 ELSE 0 END) AS {f}" for f in cohort.FLAGS)}
  FROM plines l JOIN code c ON c.k = l.l_partkey AND c.p_size > 10 LEFT JOIN hit h ON h.k = c.k WHERE l.l_returnflag <> 'R' GROUP BY l.patient_key)"""


@query("condition_flags", f"""WITH {_CLINICAL_SQL},
{_FLAGS_SQL}
SELECT c.c_custkey AS patient_key, {", ".join(f"coalesce({f}, 0) AS {f}" for f in cohort.FLAGS)} FROM customer c LEFT JOIN flags ON flags.patient_key = c.c_custkey""")
def condition_flags(t: Tables):
    from ..operators.code_flags import flag_columns
    patients = t.customer.select(F.col("c_custkey").alias("patient_key"))
    masks = cohort.condition_flags(clinical_tables(t), patients)
    return patients.join(masks, "patient_key", "left").select("patient_key", *flag_columns(cohort.FLAGS))


def _cohort_sql() -> str:
    cpt = sql_choice('p_partkey', CPTS)
    med = sql_choice('p_partkey', MED_NAMES)
    gen = sql_choice('p_partkey', GENERICS)

    def any_like(ps):
        return " OR ".join(f"upper(coalesce(name, '')) LIKE '{p}' OR upper(coalesce(generic, '')) LIKE '{p}'" for p in ps)
    img = ", ".join(f"CAST(max(CASE WHEN m = '{m}' THEN CAST(moment AS DATE) END) AS VARCHAR) AS pre_op_{m}_date" for m in cat.MODALITIES)
    days = "date_diff('day', {a}, {b})"
    return f"""WITH {_CLINICAL_SQL},
{_FLAGS_SQL},
cpts AS (SELECT l_orderkey AS case_key, {cpt} AS cpt, p_name FROM lineitem JOIN part ON p_partkey = l_partkey),
coh AS (SELECT c.*, p.mrn, p.name AS patient_name, p.birth_date, p.sex, p.race, p.ethnicity, p.postal_code, p.smoking_status, s.s_name AS surgeon_name, n.n_name AS department_name
  FROM cases c JOIN patient p ON p.patient_key = c.patient_key AND p.is_current = 1 AND p.is_valid = 1 JOIN supplier s ON s.s_suppkey = c.case_key % 10
  JOIN nation n ON n.n_nationkey = c.patient_key % 25
  WHERE c.surgery_date >= DATE '1996-08-02' AND EXISTS (SELECT 1 FROM cpts x WHERE x.case_key = c.case_key AND x.cpt IN ('{"', '".join(cohort.SHOULDER_CODES)}'))),
cp AS (SELECT case_key, string_agg(DISTINCT p_name, ' || ' ORDER BY p_name) AS procedure_names, string_agg(DISTINCT cpt, ' || ' ORDER BY cpt) AS cpt_codes, min(cpt) AS primary_cpt FROM cpts GROUP BY case_key),
sd AS (SELECT l_orderkey AS case_key, string_agg(DISTINCT {sql_choice('l_linenumber', ['Food', 'Housing', 'Transport'])}, ' || ' ORDER BY {sql_choice('l_linenumber', ['Food', 'Housing', 'Transport'])}) AS social_domains,
   string_agg(DISTINCT l_returnflag, ' || ' ORDER BY l_returnflag) AS social_concern, string_agg(DISTINCT l_linestatus, ' || ' ORDER BY l_linestatus) AS social_entries FROM lineitem GROUP BY l_orderkey),
vit AS (SELECT * FROM (SELECT b.case_key, v.bmi, v.height, v.weight, row_number() OVER (PARTITION BY b.case_key ORDER BY v.recorded DESC, v.bmi DESC, v.height DESC, v.weight DESC) AS rn
  FROM coh b JOIN vital v ON v.patient_key = b.patient_key AND v.recorded <= b.surgery_date) WHERE rn = 1),
imp AS (SELECT l_orderkey AS case_key, string_agg(DISTINCT s_name, ' || ' ORDER BY s_name) AS implants FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
  WHERE l_linestatus = 'F' AND {sql_choice('s_suppkey', ['Bone Implant', 'Drape', 'IMPLANT screw'])} ILIKE '%implant%' GROUP BY l_orderkey),
drug0 AS (SELECT p_partkey AS k, {med} AS name, {gen} AS generic FROM part),
drug AS (SELECT k, coalesce(name, generic) AS med, CASE WHEN {any_like(cat.STEROIDS)} THEN 'STEROID' WHEN {any_like(cat.NSAIDS)} THEN 'NSAID' END AS cls FROM drug0),
meds AS (SELECT b.case_key, string_agg(DISTINCT CASE WHEN d.cls = 'STEROID' THEN d.med END, ' || ' ORDER BY CASE WHEN d.cls = 'STEROID' THEN d.med END) AS steroid_use,
   string_agg(DISTINCT CASE WHEN d.cls = 'NSAID' THEN d.med END, ' || ' ORDER BY CASE WHEN d.cls = 'NSAID' THEN d.med END) AS nsaid_use
  FROM coh b JOIN plines l ON l.patient_key = b.patient_key AND CAST(l.l_shipdate AS DATE) >= b.surgery_date AND CAST(l.l_shipdate AS DATE) < b.surgery_date + 11
  JOIN drug d ON d.k = l.l_partkey AND d.cls IS NOT NULL GROUP BY b.case_key),
pimg AS (SELECT case_key, {img} FROM (SELECT b.case_key, {_first_match('i.name', cat.MODALITIES)} AS m, i.moment,
    row_number() OVER (PARTITION BY b.case_key, {_first_match('i.name', cat.MODALITIES)} ORDER BY i.moment DESC) AS rn
  FROM coh b JOIN img i ON i.patient_key = b.patient_key AND i.moment < b.surgery_date) WHERE rn = 1 AND m IS NOT NULL GROUP BY case_key),
ad AS (SELECT patient_key, day, min(coalesce(dx, 'Not documented')) AS reason FROM adm WHERE has_dx AND p_size > 10 GROUP BY ALL),
re AS (SELECT b.case_key, a.day, a.reason, {days.format(a='b.surgery_date + 5', b='a.day')} AS gap FROM coh b JOIN ad a ON a.patient_key = b.patient_key
   AND {days.format(a='b.surgery_date + 5', b='a.day')} BETWEEN 1 AND 90),
readm AS (SELECT case_key, string_agg(CASE WHEN gap <= 30 THEN CAST(day AS VARCHAR) END, ', ' ORDER BY day) AS readmission_dates_30, string_agg(CASE WHEN gap <= 30 THEN reason END, ', ' ORDER BY day) AS readmission_reasons_30,
   string_agg(CASE WHEN gap > 30 THEN CAST(day AS VARCHAR) END, ', ' ORDER BY day) AS readmission_dates_90, string_agg(CASE WHEN gap > 30 THEN reason END, ', ' ORDER BY day) AS readmission_reasons_90 FROM re GROUP BY case_key),
edv AS (SELECT * FROM (SELECT b.case_key, CAST(e.ts - INTERVAL 24 YEARS AS DATE) AS day, e.event_type, row_number() OVER (PARTITION BY b.case_key ORDER BY CAST(e.ts - INTERVAL 24 YEARS AS DATE), e.event_type) AS rn
  FROM coh b JOIN events e ON e.user_id = b.patient_key AND date_diff('day', b.surgery_date, CAST(e.ts - INTERVAL 24 YEARS AS DATE)) BETWEEN 0 AND 30) WHERE rn = 1),
aged AS (SELECT *, CAST(year(surgery_date) - year(birth_date) - CASE WHEN birth_date + to_years(CAST(year(surgery_date) - year(birth_date) AS INTEGER)) > surgery_date THEN 1 ELSE 0 END AS INTEGER) AS age FROM coh)
SELECT b.case_key, 'C' || CAST(b.case_key AS VARCHAR) AS case_id, b.department_name, b.mrn, b.patient_name, CAST(b.birth_date AS VARCHAR) AS birth_date, b.age AS age_at_surgery,
  CASE WHEN b.age >= 65 THEN 'Yes' ELSE 'No' END AS age_over_65_flag, b.sex, b.race, b.ethnicity, b.postal_code, CAST(b.surgery_date AS VARCHAR) AS surgery_date, b.surgeon_name, b.o_totalprice AS total_cost,
  b.asa_rating, CASE b.o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 1 END AS asa_score, b.smoking_status,
  cp.procedure_names, cp.cpt_codes, cp.primary_cpt, b.o_orderpriority AS financial_class, CAST(b.surgery_date AS VARCHAR) AS stay_admission, CAST(b.surgery_date + 5 AS VARCHAR) AS stay_discharge, 5 AS billing_los,
  dx.p_name AS diagnosis, sd.social_domains, sd.social_concern, sd.social_entries, vit.bmi, vit.height, vit.weight, CASE WHEN vit.bmi IS NULL THEN 'Unknown' WHEN vit.bmi >= 30 THEN 'Yes' ELSE 'No' END AS bmi_over_30_flag,
  b.patient_key % 9 AS charlson_index, {sql_choice('b.patient_key', ['Independent', 'Assisted', None])} AS functional_status, CASE WHEN cu.c_nationkey * 10 <= 90 THEN 1 ELSE 0 END AS recent_admission_flag,
  imp.implants, meds.steroid_use, meds.nsaid_use, pimg.* EXCLUDE (case_key), readm.* EXCLUDE (case_key), CAST(edv.day AS VARCHAR) AS ed_visit_date, edv.event_type AS ed_visit_reason,
  {", ".join(f"coalesce(flags.{f}, 0) AS {f}" for f in cohort.FLAGS)}
FROM aged b JOIN customer cu ON cu.c_custkey = b.patient_key LEFT JOIN cp ON cp.case_key = b.case_key LEFT JOIN part dx ON dx.p_partkey = b.case_key % 200 LEFT JOIN sd ON sd.case_key = b.case_key
LEFT JOIN vit ON vit.case_key = b.case_key LEFT JOIN imp ON imp.case_key = b.case_key LEFT JOIN meds ON meds.case_key = b.case_key LEFT JOIN pimg ON pimg.case_key = b.case_key
LEFT JOIN readm ON readm.case_key = b.case_key LEFT JOIN edv ON edv.case_key = b.case_key LEFT JOIN flags ON flags.patient_key = b.patient_key"""


@query("comorbidity_cohort", _cohort_sql())
def comorbidity_cohort(t: Tables):
    return cohort.comorbidity_cohort(clinical_tables(t), COHORT_DATE, cohort.SHOULDER_CODES)


_MART_SQL = f"""WITH {_CLINICAL_SQL},
first_case AS (SELECT patient_key, min(admission_date) AS first_day, min(discharge_date) AS first_out FROM base GROUP BY patient_key),
later AS (SELECT a.* FROM adm a JOIN first_case f ON f.patient_key = a.patient_key AND a.day > f.first_day),
rd AS (SELECT patient_key, string_agg(DISTINCT CAST(day AS VARCHAR), ',' ORDER BY CAST(day AS VARCHAR)) AS readmission_dates FROM later GROUP BY patient_key),
rx AS (SELECT patient_key, string_agg(dx, ', ' ORDER BY dx) AS readmission_dx FROM later WHERE dx IS NOT NULL GROUP BY patient_key),
rs AS (SELECT b.case_key, string_agg(DISTINCT l.status, ',' ORDER BY l.status) AS readmission_status FROM base b JOIN later l ON l.patient_key = b.patient_key AND l.day > b.admission_date GROUP BY b.case_key),
med AS (SELECT patient_key, string_agg(p_type, ', ' ORDER BY p_type) AS current_medication FROM plines JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'A' GROUP BY patient_key),
im AS (SELECT patient_key, line_key, moment, narrative FROM img),
pre AS (SELECT * FROM (SELECT i.patient_key, CAST(i.moment AS DATE) AS day, i.narrative, row_number() OVER (PARTITION BY i.patient_key ORDER BY i.moment DESC, i.line_key DESC) AS rn
  FROM base b JOIN im i ON i.patient_key = b.patient_key AND CAST(i.moment AS DATE) = b.admission_date AND CAST(i.moment AS DATE) < b.surgery_date) WHERE rn = 1),
post AS (SELECT * FROM (SELECT i.patient_key, CAST(i.moment AS DATE) AS day, i.narrative, row_number() OVER (PARTITION BY i.patient_key ORDER BY i.moment DESC, i.line_key DESC) AS rn
  FROM base b JOIN im i ON i.patient_key = b.patient_key AND CAST(i.moment AS DATE) > b.surgery_date AND CAST(i.moment AS DATE) <= b.discharge_date) WHERE rn = 1),
fimg AS (SELECT DISTINCT i.patient_key, CAST(i.moment AS DATE) AS day, i.narrative FROM im i JOIN first_case f ON f.patient_key = i.patient_key WHERE CAST(i.moment AS DATE) >= f.first_out),
fc AS (SELECT patient_key, count(*) AS n, min(day) AS day FROM fimg GROUP BY patient_key)"""


@query("datamart_wide", f"""{_MART_SQL}
SELECT b.case_key, b.patient_key, b.mrn, CAST(b.surgery_date AS VARCHAR) AS surgery_date, b.procedure_name, CAST(b.admission_date AS VARCHAR) AS admission_date, CAST(b.discharge_date AS VARCHAR) AS discharge_date,
  b.los, b.post_op_los, b.sex, b.bmi, b.height, b.weight, b.asa_rating, b.diabetes_mellitus, b.hypertension, rs.readmission_status, rd.readmission_dates, rx.readmission_dx, med.current_medication,
  CAST(pre.day AS VARCHAR) AS pre_op_imaging_date, pre.narrative AS pre_op_imaging_result, CAST(post.day AS VARCHAR) AS post_op_imaging_date, post.narrative AS post_op_imaging_result,
  fc.n AS follow_up_images, CAST(fc.day AS VARCHAR) AS first_follow_up_imaging_date,
  {sql_choice('b.patient_key', ['Stage I', 'Stage II', None])} AS stage_description, {sql_choice('b.patient_key', ['G1', 'G2'])} AS histologic_grade, b.patient_key % 60 AS tumor_size_mm,
  {sql_choice('b.patient_key', ['R0', 'R1'])} AS residual_tumor, {sql_choice('b.patient_key', ['Absent', 'Present'])} AS lymph_vascular_invasion, {sql_choice('b.patient_key', ['L0', 'L1', None])} AS lymphatic_invasion,
  coalesce(h.hyperlipidemia, 0) AS hyperlipidemia, coalesce(h.coronary_artery_disease, 0) AS coronary_artery_disease
FROM base b LEFT JOIN rs ON rs.case_key = b.case_key LEFT JOIN rd ON rd.patient_key = b.patient_key LEFT JOIN rx ON rx.patient_key = b.patient_key LEFT JOIN med ON med.patient_key = b.patient_key
LEFT JOIN pre ON pre.patient_key = b.patient_key LEFT JOIN post ON post.patient_key = b.patient_key LEFT JOIN fc ON fc.patient_key = b.patient_key LEFT JOIN hist h ON h.patient_key = b.patient_key""")
def datamart_wide(t: Tables):
    return datamart.surgical_datamart(clinical_tables(t), "SUPPLIER%")


@query("datamart_follow_up", f"""{_MART_SQL}
SELECT patient_key, CAST(day AS VARCHAR) AS follow_up_imaging_date, narrative AS follow_up_imaging_result FROM fimg""")
def datamart_follow_up(t: Tables):
    tables = clinical_tables(t)
    return datamart.follow_up_imaging(tables, datamart.base_population(tables, "SUPPLIER%", performed_only=False))
