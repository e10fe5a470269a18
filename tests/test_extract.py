import datetime as dt
import glob
import os

from wardflow.plans.extract import run_task
from wardflow.session import work_path
from wardflow.streaming.incremental import Extracts

RUN = dt.datetime(2025, 6, 1, 14, 30)
COLUMNS = ("task_name string, task_group string, active int, task_code string, file_format string, delimiter string, "
           "file_flags string, split_setting string, file_encoding string")


def setup(spark):
    config = spark.createDataFrame([
        ("plain", "g", 1, "rows", "OUT_YYYYMMDD.txt", "|", None, None, None),
        ("parts", "g", 1, "rows", "OUT_%Y%m%d%H%M{SPLITINDEX}.txt", None, None, "{index}|1KB|NOZIP", None),
        ("byarea", "g", 1, "rows", "OUT_<FILENAMEPART>_YYYYMMDD.csv", None, "NO_HEADER", None, None)], COLUMNS)
    processes = spark.createDataFrame([(1, "g", "SUCCESSFUL")], "process_id long, task_group string, status string")
    steps = spark.createDataFrame([(1, "plain", dt.datetime(2025, 5, 1))], "process_id long, task_name string, last_incremental timestamp_ntz")
    extracts = Extracts()

    @extracts.register("rows")
    def rows(s, params):
        seen.append(params["watermark"])
        return s.range(200).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'N' ELSE 'S' END AS area"), dt.datetime(2025, 5, 30)
    seen = []
    return config, processes, steps, extracts, seen


def test_task_runs(spark):
    config, processes, steps, extracts, seen = setup(spark)
    out, audit = work_path(spark, "t-task"), work_path(spark, "t-task-audit")

    def run(name, n, **kw):
        return run_task(spark, name, config, processes, steps, extracts, f"{out}/{name}", audit, n, RUN, **kw)
    plain = run("plain", 5)
    assert plain["target_name"] == "OUT_20250601.txt" and plain["source_count"] == 200
    lines = [x for f in glob.glob(f"{out}/plain/OUT_20250601.txt/part-*") for x in open(f).read().split("\n") if x]
    assert "id|area" in lines and "7|S" in lines

    parts = run("parts", 6)
    folders = glob.glob(f"{out}/parts/{parts['target_name']}/part=*")
    sizes = [len(open(f, "rb").read()) for p in folders for f in glob.glob(f"{p}/part-*")]
    assert len(folders) == len(sizes) == 2 and max(sizes) <= 1024 and parts["target_count"] == 200

    params = spark.createDataFrame([("N", "North"), ("S", "South"), ("E", "East")], "area string, file_name_part string")
    by_area = run("byarea", 7, params=params, param_keys=["area"])
    names = sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{out}/byarea/file_name=*"))
    assert names == ["OUT_North_20250601.csv", "OUT_South_20250601.csv"] and by_area["source_count"] == 200

    assert seen == [dt.datetime(2025, 5, 1), dt.datetime(2025, 5, 29), dt.datetime(2025, 5, 29)]
    saved = spark.read.parquet(audit).orderBy("process_id").collect()
    assert [r.task_name for r in saved] == ["plain", "parts", "byarea"]
    assert all(r.last_incremental == dt.datetime(2025, 5, 30) for r in saved)


def test_task_writes_exact_files(spark):
    """Names, bytes in the task's code page, parts that restart for each parameter, and the audit row."""
    config, processes, steps, extracts, _ = setup(spark)
    more = spark.createDataFrame([
        ("both", "g", 1, "rows", "OUT_<FILENAMEPART>_YYYYMMDD{SPLITINDEX}.csv", "|", None, "_{index:02}|0.5KB|NOZIP", "cp1252")], COLUMNS)
    config = config.unionByName(more)
    out, audit = work_path(spark, "t-files"), work_path(spark, "t-files-audit")

    def run(name, n, **kw):
        result = run_task(spark, name, config, processes, steps, extracts, f"{out}/{name}", audit, n, RUN, layout="files", order=["id"], **kw)
        folder = f"{out}/{name}".removeprefix("file:")
        return result, {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{folder}/*.*")}

    result, files = run("plain", 1)
    assert files == {"OUT_20250601.txt": b"id|area\r\n" + b"".join(f"{i}|{'NS'[i % 2]}\r\n".encode() for i in range(200))}
    assert result["target_name"] == "OUT_20250601.txt" and result["target_count"] == result["source_count"] == 200

    _, files = run("parts", 2)
    assert sorted(files) == ["OUT_2025060114301.txt", "OUT_2025060114302.txt"] and max(map(len, files.values())) <= 1024
    assert b"".join(f.split(b"\r\n", 1)[1] for _, f in sorted(files.items())) == b"".join(f"{i},{'NS'[i % 2]}\r\n".encode() for i in range(200))

    params = spark.createDataFrame([("N", "Nörd"), ("S", "South"), ("E", "East")], "area string, file_name_part string")
    result, files = run("byarea", 3, params=params, param_keys=["area"])
    assert {k: v.count(b"\r\n") for k, v in files.items()} == {"OUT_Nörd_20250601.csv": 100, "OUT_South_20250601.csv": 100, "OUT_East_20250601.csv": 0}

    result, files = run("both", 4, params=params, param_keys=["area"])
    assert sorted(files) == [f"OUT_{p}_20250601_0{k}.csv" for p in ("Nörd", "South") for k in (1, 2)] and result["target_count"] == 200
    assert all(len(f) <= 512 and f.startswith(b"id|area\r\n") for f in files.values())
    assert spark.read.parquet(audit).count() == 4
