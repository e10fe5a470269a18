import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardflow.functions import clinical, conditions, dates, keys, text
from wardflow.operators.followup import bucket_of
from wardflow.plans import billing


def one(spark, schema, row, *cols):
    return spark.createDataFrame([row], schema).select(*cols).first()


TS = "a timestamp_ntz, b timestamp_ntz"


@pytest.mark.parametrize("unit,a,b,want", [
    ("month", "2024-01-31 00:00", "2024-02-01 00:00", 1), ("year", "2024-12-15 00:00", "2025-02-01 00:00", 1),
    ("week", "2024-01-07 00:00", "2024-01-08 00:00", 1), ("day", "2024-01-07 23:00", "2024-01-08 01:00", 1),
    ("minute", "2024-01-07 10:00:59", "2024-01-07 10:01:00", 1), ("week", "2024-01-08 00:00", "2024-01-14 00:00", 0),
    ("month", "2024-03-01 00:00", "2024-02-29 00:00", -1)])
def test_boundaries(spark, unit, a, b, want):
    row = (dt.datetime.fromisoformat(a), dt.datetime.fromisoformat(b))
    assert one(spark, TS, row, dates.boundary_diff(unit, "a", "b"))[0] == want


@pytest.mark.parametrize("at,want", [
    ("2024-12-18", None), ("2024-12-31", None), ("2024-12-23", "w1"), ("2025-01-10", "m1"), ("2025-02-01", "y1"),
    ("2025-03-10", "m3"), ("2025-06-10", "m6"), ("2026-01-05", "ygt1")])
def test_followup_bucket(spark, at, want):
    row = (dt.datetime(2024, 12, 15 + 1), dt.datetime.fromisoformat(at))      # index on a Monday
    assert one(spark, TS, row, bucket_of("a", "b"))[0] == want


def test_followup_bucket_sunday_index(spark):
    row = (dt.datetime(2024, 12, 15), dt.datetime(2024, 12, 18))
    assert one(spark, TS, row, bucket_of("a", "b"))[0] == "w1"


@pytest.mark.parametrize("name,last,first,legacy", [
    ("DOE, JOHN A", "DOE", "JOHN", "JOH"), ("DOE,JOHN A", "DOE", "JOHN", "JOHN"), ("DOE, JOHN", "DOE", "JOHN", "JOHN"),
    ("DOE JOHN", None, None, None), (",JOHN", None, "JOHN", "JOHN")])
def test_split_name(spark, name, last, first, legacy):
    got = one(spark, "n string", (name,), *text.split_name("n"), text.split_name("n", legacy=True)[1])
    assert tuple(got) == (last, first, legacy)


def test_concat_rules(spark):
    got = one(spark, "p string, c string, h string", ("PLAN", None, "HMO"),
              text.concat_tsql("p", F.lit(" "), "c", F.lit(" "), "h"), text.concat_strict("p", "c"))
    assert got[0] == "PLAN  HMO" and got[1] is None
    assert one(spark, "p string, c string", (None, "CITY"), text.concat_tsql("p", F.lit(" "), "c", F.lit(" "), F.lit("HMO")))[0] == " CITY HMO"


@pytest.mark.parametrize("value,want", [("12", 1), ("1A", 0), ("-", 1), ("$5", 1), ("1,0", 1), ("", 0), (None, 0), ("GR", 0), (".", 1), ("1e", 0)])
def test_isnumeric(spark, value, want):
    assert one(spark, "x string", (value,), text.tsql_isnumeric("x"))[0] == want


@pytest.mark.parametrize("ext,own,want", [(None, "ABC123", "123"), (None, "A", None), ("X9", "ABC123", "X9"), (None, "AB", None), (None, "ABC", "")])
def test_subscriber_id(spark, ext, own, want):
    own_id = F.when(text.tsql_len("own") > 1, text.drop_first("own", 3))
    assert one(spark, "ext string, own string", (ext, own), F.coalesce("ext", own_id))[0] == want


@pytest.mark.parametrize("template,date_part,name_part,want", [
    ("GAPINCARE_YYYYMMDD.txt", None, None, "GAPINCARE_20250601.txt"), ("PFA_NH_mmddyyyy.txt", None, None, "PFA_NH_06012025.txt"),
    ("X_%Y%m%d%H%M.txt", None, None, "X_202506011430.txt"), ("Visits_<DATEPART>.csv", "2025.06", None, "Visits_2025.06.csv"),
    ("PB_CBO_Outcome_<FILENAMEPART>_YYYYMMDD.csv", None, "North", "PB_CBO_Outcome_North_20250601.csv"),
    ("Epic_VisitType.txt", None, None, "Epic_VisitType.txt"), ("plain.txt", None, None, "plain.txt")])
def test_report_name(spark, template, date_part, name_part, want):
    row = (dt.datetime(2025, 6, 1, 14, 30), date_part, name_part)
    got = one(spark, "at timestamp_ntz, d string, n string", row, text.report_name(template, "at", "n", "d"))
    assert got[0] == want


def test_split_index_names(spark):
    row = (dt.datetime(2025, 6, 1), 7)
    name = text.report_name("LOG_YYYYMMDD{SPLITINDEX}.log", "at", split_index=text.split_index_text("_{index:03}", "i"))
    assert one(spark, "at timestamp_ntz, i int", row, name)[0] == "LOG_20250601_007.log"
    assert one(spark, "i int", (12345,), text.split_index_text("{index:03}", "i"))[0] == "12345"


def test_split_setting():
    assert text.parse_split_setting("{_index}|500MB|NOZIP") == ("{_index}", 500.0, "MB", False)
    assert text.parse_split_setting("_part{index}|300.5KB|ZIPFILES") == ("_part{index}", 300.5, "KB", True)
    for bad in ("{index}|500MB", "{index}|500|NOZIP", "{index}|1GB|MAYBE"):
        with pytest.raises(ValueError):
            text.parse_split_setting(bad)


@pytest.mark.parametrize("run,start,end,bill", [
    (dt.date(2025, 4, 1), dt.date(2025, 2, 15), dt.date(2025, 3, 15), dt.date(2025, 4, 15)),
    (dt.date(2025, 4, 16), dt.date(2025, 3, 15), dt.date(2025, 4, 15), dt.date(2025, 5, 15))])
def test_month_windows(spark, run, start, end, bill):
    grid = dates.month_grid("run")
    got = one(spark, "run date, s string, e string, b string", (run, "15th of prior Month - 2", "15th of prior month-1", "15th of month"),
              billing.window_start("s", grid), billing.window_end("e", grid), billing.next_billing("b", grid))
    assert tuple(got) == (start, end, bill)


@pytest.mark.parametrize("rule,mid,plain", [
    ("1 Month", dt.date(2025, 2, 15), dt.date(2025, 3, 1)), ("2 Months", dt.date(2025, 1, 15), dt.date(2025, 1, 1)),
    ("45 Days", dt.date(2025, 2, 1), dt.date(2025, 2, 15)), ("Modified 2 Months", dt.date(2025, 1, 15), dt.date(2025, 1, 1)),
    ("other", dt.date(2099, 1, 1), dt.date(2099, 1, 1))])
def test_lookback(spark, rule, mid, plain):
    schema = "rule string, er string, e date"
    assert one(spark, schema, (rule, "15th of prior month-1", dt.date(2025, 3, 15)), billing.lookback_start("rule", "er", "e"))[0] == mid
    assert one(spark, schema, (rule, "Last day of prior month", dt.date(2025, 3, 31)), billing.lookback_start("rule", "er", "e"))[0] == plain
    if rule in ("1 Month", "2 Months"):
        v1 = one(spark, schema, (rule, "15th of prior month-1", dt.date(2025, 3, 15)), billing.lookback_start("rule", "er", "e", version=1))[0]
        assert v1 == mid + dt.timedelta(days=1)


@pytest.mark.parametrize("plan,want", [
    ("ANTHEM MEDICAID - CA", "Anthem CA Medicaid"), ("WELLPOINT MEDICAID - TX", "Anthem CA Medicaid"), ("OTHER PLAN", "Anthem Medicaid"), (None, "")])
def test_primary_contract(spark, plan, want):
    got = one(spark, "p string, c string, f string", (plan, "X", "Y"), billing.primary_contract("p", "c", "f"))
    assert got[0] == f"{want} X Y"


def test_primary_contract_strict(spark):
    def label(p, f="Y"):
        return one(spark, "p string, c string, f string", (p, "X", f), billing.primary_contract("p", "c", "f", strict=True))[0]
    assert label("WELLPOINT MEDICAID - TX") == "Anthem Medicaid X Y"
    assert label("AMERIGROUP COMMERCIAL") == "Anthem Commercial FI X Y"
    assert label("ANTHEM COMMERCIAL ASO", "Medicare Replacement") == "Anthem Medicare X Medicare Replacement"
    assert label("OTHER PLAN") == "OTHER PLAN X Y"


@pytest.mark.parametrize("at,want", [(dt.date(2023, 2, 27), 22), (dt.date(2023, 2, 28), 23)])
def test_age(spark, at, want):
    assert one(spark, "b date, a date", (dt.date(2000, 2, 29), at), dates.age_at("b", "a"))[0] == want


def test_asa_and_flags(spark):
    rows = [("Morbund", 5), (" severe systemic disease ", 3), ("*Unspecified", None), ("nothing", None), (None, None)]
    df = spark.createDataFrame(rows, "t string, want int").select(clinical.asa_score("t").alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())
    meds = [("Prednisone", None, "STEROID"), ("Advil", "ibuprofen", "NSAID"), ("Celecoxib", "dexamethasone", "STEROID"), (None, None, None)]
    df = spark.createDataFrame(meds, "n string, g string, want string").select(clinical.medication_class("n", "g").alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())


def test_solitary_kidney_first_match(spark):
    got = one(spark, "v string", ("Z90.49",), clinical.first_match("v", clinical.SOLITARY_KIDNEY))[0]
    assert got == "Acquired absence of kidney"


def test_not_like_drops_null(spark):
    df = spark.createDataFrame([("ANTHEM COMMERCIAL ASO",), ("x",), (None,)], "p string")
    assert [r.p for r in df.where(text.not_like_all("p", billing.EXCLUDED_PLANS)).collect()] == ["x"]


def test_date_dim_and_keys(spark):
    d = dates.date_dim(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1)).orderBy("date_key").collect()
    assert [r.date_key for r in d] == [20240228, 20240229, 20240301]
    assert d[1].month_end == dt.date(2024, 2, 29) and d[2].month_start == dt.date(2024, 3, 1)
    row = one(spark, "k int, s string", (-1, "*Unknown"), keys.real_key("k"), keys.no_end_key("k"), keys.is_sentinel("s"), dates.key_to_date("k"))
    assert tuple(row) == (False, True, True, None)
    assert dates.run_date_or_today(dt.date(1900, 1, 1)) == dt.date.today()


def test_pattern_rows():
    rows = conditions.pattern_rows(conditions.COMORBIDITY)
    assert {("liver", "prefix", "K73."), ("liver", "prefix", "K74."), ("htn", "exact", "I10"), ("aids", "prefix", "043")} <= set(rows)
    assert len(rows) == len(set(rows)) and len(conditions.flags(conditions.COMORBIDITY)) == 40
    undotted = conditions.pattern_rows(conditions.COMORBIDITY, code_format="undotted")
    assert ("chf", "exact", "I0981") in undotted and not any("." in t for _, _, t in undotted)
    assert ("functional_disability_flag", "exact", "R53.2") in conditions.pattern_rows(conditions.PATIENT, code_format="dotted")
