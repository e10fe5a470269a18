"""Packing, code pages and named files against plain versions."""

import csv
import glob
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from wardflow.session import work_path
from wardflow.sinks import codepage, named, packing


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def plain_parts(rows, capacity):
    """(name, id, part, bytes, offset) of (name, id, bytes) rows."""
    outputs, out = {}, []
    for name, i, size in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        outputs.setdefault(name, []).append((i, size))
    for name, xs in outputs.items():
        used, part, offset = None, 0, 0
        for i, size in xs:
            if used is None or used + size > capacity:
                part, used = part + 1, 0
            used += size
            out.append((name, i, part, size, offset))
            offset += size
    return sorted(out, key=str)


@pytest.mark.parametrize("capacity, largest", [(100, 30), (1000, 30), (50, 80), (7, 3), (100_000, 50)])
def test_pack_is_exact(spark, capacity, largest):
    """A hot name over many blocks, rows larger than a part, names without a value."""
    random_ = random.Random(capacity)
    rows = [(random_.choice(["hot", "hot", "a", "b", None]), i, random_.randrange(1, largest)) for i in range(3000)]
    df = spark.createDataFrame(rows, "name string, id int, b int").repartition(5)
    got = packing.pack(df, F.col("b"), ["id"], capacity, "name").select("name", "id", "part", "line_bytes", "line_offset").collect()
    assert sorted(map(tuple, got), key=str) == plain_parts(rows, capacity)


def test_pack_one_output_and_none(spark):
    df = spark.range(100).withColumn("b", F.lit(10))
    assert packing.pack(df, F.col("b"), ["id"], 30).agg(F.max("part"), F.count("*")).first() == (34, 100)
    assert packing.pack(df.where("id < 0"), F.col("b"), ["id"], 30).count() == 0


def python_bytes(rows, encoding, quoting=csv.QUOTE_MINIMAL, sep=","):
    out = io.BytesIO()
    text = io.TextIOWrapper(out, encoding=encoding, errors="replace", newline="")
    csv.writer(text, delimiter=sep, quotechar='"', quoting=quoting).writerows(rows)
    text.flush()
    return out.getvalue()


@pytest.mark.parametrize("encoding", [None, "utf-8", "cp1252", "windows-1252", "latin-1", "cp850", "utf-16-le"])
@pytest.mark.parametrize("quote_all", [False, True])
def test_lines_equal_the_csv_writer(spark, encoding, quote_all):
    rows = [(1, "plain", "x"), (2, "line\nbreak", 'quo"te'), (3, "a,b\r", "€ é ß"), (4, None, ""), (5, "\U0001F600 字 \u0081", "Ώ")]
    df = codepage.with_lines(spark.createDataFrame(rows, "id int, a string, b string"), ["id", "a", "b"], ",", quote_all, encoding)
    got = b"".join(bytes(r.line) for r in df.orderBy("id").collect())
    assert got == python_bytes(rows, encoding or "utf-8", csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL)
    one = codepage.with_lines(spark.createDataFrame([("",), ("x",)], "a string"), ["a"]).collect()
    assert [bytes(r.line) for r in one] == [b'""\r\n', b"x\r\n"]
    with pytest.raises(ValueError):
        codepage.charset("utf-7")


def test_every_character_of_a_code_page(spark):
    text = [chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    df = codepage.with_lines(spark.createDataFrame(list(enumerate(text)), "id int, c string"), ["c"], encoding="cp1252").orderBy("id")
    assert [bytes(r.line) for r in df.collect()] == [python_bytes([(c,)], "cp1252") for c in text]
    assert spark.conf.get("spark.sql.legacy.codingErrorAction") == "false"  # the session stays as it was


def test_named_files(spark):
    df = spark.createDataFrame([(f"f{i % 7}.txt", i) for i in range(500)], "file_name string, id long").repartition(6)
    rows, path = codepage.with_lines(df, ["id"], encoding="cp1252"), work_path(spark, "t-named")
    names = spark.createDataFrame([("empty.txt",), ("f0.txt",)], "file_name string")
    log = {r.file_name: (r.rows, r.bytes) for r in named.write_named(rows, path, F.col("line"), ["id"], b"ID\r\n", names).collect()}
    found = {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{local(path)}/*.txt")}
    want = {f"f{k}.txt": b"ID\r\n" + b"".join(b"%d\r\n" % i for i in range(k, 500, 7)) for k in range(7)} | {"empty.txt": b"ID\r\n"}
    assert found == want and log == {n: (t.count(b"\r\n") - 1, len(t)) for n, t in want.items()}
    assert not os.path.exists(f"{local(path)}/_staging/") or not os.listdir(f"{local(path)}/_staging")


def test_a_failed_job_leaves_no_file(spark):
    df = spark.createDataFrame([("a.txt", 1), ("../b.txt", 2)], "file_name string, id long").repartition(2)
    path = work_path(spark, "t-named")
    with pytest.raises(Exception, match="not a file name"):
        named.write_named(codepage.with_lines(df, ["id"]), path, F.col("line"), ["id"])
    assert [f for _, _, fs in os.walk(local(path)) for f in fs] == []


def test_a_second_attempt_replaces_the_first(tmp_path):
    """What a killed attempt left in the staging folder is not published."""
    import pyarrow as pa
    batch = pa.record_batch([["x.txt"], pa.array([1], pa.int32()), [b"one\r\n"]], ["file_name", "rows", "line"])
    writer = named.NamedFileWriter(str(tmp_path), "job")
    killed = writer.write(iter([batch]))
    done = writer.write(iter([batch]))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["_staging"] and killed.files[0][1] != done.files[0][1]
    writer.commit([done, None])
    assert sorted(p.name for p in tmp_path.iterdir() if p.is_file()) == ["x.txt"] and not (tmp_path / "_staging" / "job").exists()
    with pytest.raises(ValueError, match="two tasks"):
        writer.commit([done, done])
