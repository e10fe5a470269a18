import csv
import datetime as dt
import glob
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.session import work_path
from wardflow.sinks import delimited, split
from wardflow.sources import files, nested
from wardflow.streaming import incremental, survey


def read_parts(path, pattern="part-*"):
    return [open(f, "rb").read() for f in sorted(glob.glob(f"{path}/{pattern}"))]


ROWS = [(1, 'say "hi"', "a|b"), (2, None, ""), (3, " pad ", "line\nbreak"), (4, "é", "plain")]


def test_delimited_like_a_csv_writer(spark):
    df = spark.createDataFrame(ROWS, "id int, a string, b string").coalesce(1)
    path = work_path(spark, "t-csv")
    delimited.write_delimited(df, path, "|")
    out = io.StringIO()
    w = csv.writer(out, delimiter="|", lineterminator="\r\n")
    w.writerow(["id", "a", "b"])
    w.writerows(ROWS)
    assert b"".join(read_parts(path)).decode() == out.getvalue()
    lines = [r.l for r in df.orderBy("id").select(delimited.line(["id", "a", "b"], "|").alias("l")).collect()]
    assert "\r\n".join([delimited.header_line(["id", "a", "b"], "|"), *lines]) + "\r\n" == out.getvalue()


def test_header_in_every_file_and_without_rows(spark):
    path = work_path(spark, "t-head")
    assert delimited.write_delimited(spark.range(40).repartition(4), path) == 40
    parts = read_parts(path)
    assert len(parts) == 4 and all(p.startswith(b"id\r\n") for p in parts)
    assert sorted(int(x) for p in parts for x in p.decode().split()[1:]) == list(range(40))
    empty = work_path(spark, "t-head-empty")
    assert delimited.write_delimited(spark.range(0), empty) == 0
    assert b"".join(read_parts(empty)) == b"id\r\n"


def test_delimited_flags_and_code_page(spark):
    df = spark.createDataFrame([(1, "é ☃")], "id int, a string").coalesce(1)
    path = work_path(spark, "t-cp")
    delimited.write_delimited(df, path, ",", "NO_HEADER|ADD_QUOTE", "windows-1252")
    assert b"".join(read_parts(path)) == '"1","é ?"\r\n'.encode("cp1252")
    assert delimited.parse_file_flags(None) == (True, False)


def test_survey_file_read(spark, tmp_path):
    text = 'surveyid|Program Name|question_id|answer_txt\n12|"A|B"|Q1|caf\xe9\n13|P|Q2|\n'
    (tmp_path / "in.csv").write_bytes(text.encode("cp1252"))
    (tmp_path / "other.txt").write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.csv").write_text(text)
    assert files.any_match(spark, str(tmp_path), "*.csv") and not files.any_match(spark, str(tmp_path), "*.zip")
    raw = files.read_delimited(spark, str(tmp_path), files.survey_schema(), file_spec="*.csv")
    rows = survey.stage(raw, dt.datetime(2025, 1, 1)).orderBy("surveyid").collect()
    assert [(r.surveyid, r.program_name, r.question_id, r.answer_txt) for r in rows] == [(12, "A|B", "Q1", "café"), (13, "P", "Q2", None)]


def test_bad_survey_id_fails(spark):
    df = spark.createDataFrame([("12",), ("x",)], "surveyid string")
    with pytest.raises(Exception, match="not an integer"):
        files.to_int_or_fail(df, "surveyid").collect()


def packed(sizes, capacity):
    """Row-by-row packing."""
    parts, used = [], None
    for s in sizes:
        if used is None or used + s > capacity:
            parts.append([])
            used = 0
        parts[-1].append(s)
        used += s
    return parts


def test_split_example(spark):
    df = spark.createDataFrame([(i, "x" * 8) for i in range(7)], "id int, v string")
    got = split.split_by_size(df, F.col("v"), ["id"], 35, 5).groupBy("part").count().orderBy("part").collect()
    assert [r["count"] for r in got] == [3, 3, 1]


@pytest.mark.parametrize("shuffle", [1, 8])
def test_split_packs_exactly_whatever_the_partitions(spark, shuffle):
    rng = random.Random(5)
    rows = [(i, "é" * rng.randrange(0, 9) + ("y" * 120 if i % 97 == 50 else "")) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, v string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        got = split.split_by_size(df, F.col("v"), ["id"], 100, 10).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = [len(v.encode()) + 2 for _, v in rows]
    want = packed(sizes, 90)
    assert [r.id for r in got] == list(range(600))
    assert [r.part for r in got] == [i + 1 for i, p in enumerate(want) for _ in p]


def test_split_parts_join_back_to_the_input(spark):
    df = spark.createDataFrame([(i, f"value {i}") for i in range(200)], "id int, v string")
    text = delimited.line(["id", "v"])
    parts = split.split_by_size(df, text, ["id"], 300, 6, "_part{index:03}")
    path = work_path(spark, "t-parts")
    split.write_parts(parts, text, "id,v", path)
    lines = []
    for folder in sorted(glob.glob(f"{path}/part=*"), key=lambda p: int(p.rsplit("=", 1)[1])):
        found = read_parts(folder)
        assert len(found) == 1 and len(found[0]) <= 300
        body = found[0].decode().split("\r\n")
        assert body[0] == "id,v" and body[-1] == ""
        lines += body[1:-1]
    assert lines == [f"{i},value {i}" for i in range(200)]


def test_parameter_fanout(spark):
    df = spark.createDataFrame([(1, "N"), (2, "S"), (3, "N")], "id int, area string")
    params = spark.createDataFrame([("N", "North"), ("S", "South")], "area string, FILE_NAME_PART string")
    named = delimited.name_by_parameter(df, params, ["area"], "OUT_<FILENAMEPART>_YYYYMMDD.csv", F.lit(dt.date(2025, 6, 10)))
    path = work_path(spark, "t-fan")
    delimited.write_by_name(named.select("file_name", "id"), path)
    names = sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{path}/file_name=*"))
    assert names == ["OUT_North_20250610.csv", "OUT_South_20250610.csv"]
    assert spark.read.option("header", True).csv(path).count() == 3


def test_counts_and_reconcile(spark):
    path = work_path(spark, "t-count")
    n = delimited.write_counted(spark.range(50), lambda d: d.write.parquet(path), "step")
    assert delimited.reconcile(50, n, "step") == 50
    with pytest.raises(ValueError):
        delimited.reconcile(49, n, "step")


def test_table_sink(spark):
    name = "roster_out_" + dt.datetime.now().strftime("%H%M%S%f")
    path = work_path(spark, "t-table")
    spark.sql(f"CREATE TABLE {name} (id BIGINT) USING parquet LOCATION '{path}'")
    delimited.write_table(spark.range(3), name, truncate=False)
    delimited.write_table(spark.range(3), name, truncate=False)
    assert spark.table(name).count() == 6
    spark.sql(f"DROP TABLE {name}")


def test_nested_records(spark):
    df = spark.createDataFrame([('{"a":{"b":1},"l":[1,2]}',), ('{"a":{"b":2,"at":"2024-01-02T03:04:05Z"}}',)], "j string")
    parsed = nested.parse_json(df, "j").select("j.*")
    flat = nested.flatten(parsed)
    assert set(flat.columns) == {"a__b", "a__at", "l"}
    out = nested.call_records(parsed)
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types["a__b"] == T.LongType() and types["a__at"] == T.TimestampType() and types["l"] == T.StringType()
    rows = out.orderBy("a__b").collect()
    assert rows[0].l == "[1,2]" and rows[1].a__at == dt.datetime(2024, 1, 2, 3, 4, 5) and rows[0].a__at is None


def test_timestamp_rule_on_empty_column(spark):
    df = spark.createDataFrame([(None, "x")], "e string, t string")
    assert nested.timestamp_columns(df) == [] and nested.timestamp_columns(df, null_columns_too=True) == ["e"]


def test_watermarks(spark):
    p = spark.createDataFrame([(1, "g", "SUCCESSFUL"), (2, "g", "FAILED"), (3, "h", "SUCCESSFUL")], "process_id long, task_group string, status string")
    s = spark.createDataFrame([(1, "a", dt.datetime(2025, 5, 1)), (1, "b", None), (2, "a", dt.datetime(2025, 6, 1))],
                              "process_id long, task_name string, last_incremental timestamp_ntz")
    tasks = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "a")], "task_group string, task_name string")
    got = {(r.task_group, r.task_name): r.watermark for r in incremental.watermarks(p, s, tasks, dt.date(2025, 6, 10)).collect()}
    assert got == {("g", "a"): dt.datetime(2025, 5, 1), ("g", "b"): dt.datetime(1900, 1, 1), ("h", "a"): dt.datetime(2025, 6, 7)}


def test_extract_run_moves_its_watermark_only_after_the_write(spark):
    df = spark.createDataFrame([(i, dt.datetime(2025, 1, 1 + i)) for i in range(5)], "id int, t timestamp_ntz")
    out, audit = work_path(spark, "t-inc"), work_path(spark, "t-audit")

    def fail(_):
        raise RuntimeError("disk full")
    with pytest.raises(RuntimeError):
        incremental.run_extract(spark, df, "t", dt.datetime(2025, 1, 2), fail, audit, "g", "a", 1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(audit)
    first = incremental.run_extract(spark, df, "t", dt.datetime(2025, 1, 2), lambda d: d.write.mode("append").parquet(out), audit, "g", "a", 2)
    assert first == {"rows": 3, "watermark": dt.datetime(2025, 1, 5)}
    again = incremental.run_extract(spark, df, "t", first["watermark"], lambda d: d.write.mode("append").parquet(out), audit, "g", "a", 3)
    assert again == {"rows": 0, "watermark": dt.datetime(2025, 1, 5)}
    assert spark.read.parquet(out).count() == 3
    assert incremental.last_success(spark.read.parquet(audit), "g", "a").first().process_id == 3


def test_task_config(spark):
    c = spark.createDataFrame([(1, "x", "g", 5, 1), (2, "y", "g", 1, 0), (3, "z", "g", 1, 1)], "task_id int, task_name string, task_group string, priority int, active int")
    assert incremental.task_config(c, "x")["task_id"] == 1
    with pytest.raises(ValueError):
        incremental.task_config(c, "y")
    assert [r.task_id for r in incremental.group_config(c, "g").collect()] == [2, 3, 1]


def test_extract_registry(spark):
    e = incremental.Extracts()

    @e.register("numbers")
    def numbers(s, params):
        return s.range(params["n"]), dt.date(2025, 1, 1)
    df, mark = e.run(spark, "numbers", {"n": 4})
    assert df.count() == 4 and mark == dt.date(2025, 1, 1)
    with pytest.raises(KeyError):
        e.run(spark, "none", {})


def test_survey_stream_loads_each_answer_once(spark, tmp_path):
    folder, target, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    folder.mkdir()

    def drop(name, rows):
        body = "surveyid|Program Name|question_id|answer_txt\n" + "".join("|".join(r) + "\n" for r in rows)
        (folder / name).write_bytes(body.encode("cp1252"))
    drop("a.csv", [("1", "P", "23", "x"), ("2", "P", "1", "y")])
    survey.load_stream(spark, str(folder), target, state, "*.csv")
    survey.load_stream(spark, str(folder), target, state, "*.csv")
    assert spark.read.parquet(target).count() == 2
    drop("b.csv", [("12", "P", "3", "new"), ("1", "P", "23", "again")])
    survey.load_stream(spark, str(folder), target, state, "*.csv")
    got = sorted((r.surveyid, r.question_id, r.answer_txt) for r in spark.read.parquet(target).collect())
    assert got == [(1, "23", "x"), (2, "1", "y"), (12, "3", "new")]
    # A stream with a new checkpoint reads the files again and adds nothing; so does the batch form.
    survey.load_stream(spark, str(folder), target, str(tmp_path / "state2"), "*.csv")
    again = spark.read.parquet(target)
    assert again.count() == 3 and again.select("stream").distinct().count() == 1
    assert survey.new_answers(spark, str(folder), spark.read.parquet(target), "*.csv").count() == 0


def test_fixed_width(spark):
    df = spark.createDataFrame([("ab", "cdef"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(delimited.fixed_width({"a": 3, "b": 3})).collect()] == ["ab cde", "   x  "]
    assert [r[0] for r in df.select(delimited.fixed_width({"a": 3, "b": 9}, ragged_right=True)).collect()] == ["ab cdef", "   x"]
