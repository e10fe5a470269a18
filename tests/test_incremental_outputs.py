"""Published runs, SQL tasks, collations, ordered outputs, hot lists and the keyed survey stream."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from wardflow.functions import collation
from wardflow.operators import aggregates
from wardflow.session import work_path
from wardflow.sinks import ordered
from wardflow.streaming import publish, sql_tasks, survey

DAY = [dt.datetime(2025, 1, d) for d in range(1, 29)]
FIRST = dt.datetime(1900, 1, 1)


def frame(spark, days):
    return spark.createDataFrame([(i, DAY[i]) for i in days], "id int, t timestamp_ntz")


def run(spark, path, days, process_id, **kw):
    return publish.run_published(spark, frame(spark, days), "t", path, "g", "a", process_id, FIRST, **kw)


def test_a_run_that_dies_before_its_record_is_replaced(spark):
    path = work_path(spark, "t-publish")
    assert run(spark, path, range(3), 1) == {"rows": 3, "watermark": DAY[2], "attempt": 1}

    def die(_):
        raise RuntimeError("killed")
    with pytest.raises(RuntimeError):
        run(spark, path, range(6), 2, record=die)
    schema = frame(spark, [0]).schema
    ids = lambda: sorted(r.id for r in publish.published(spark, path, schema, "g", "a").collect())
    assert ids() == [0, 1, 2]  # what it wrote is not read
    assert len(glob.glob(f"{path.removeprefix('file:')}/data/g/a/2-*")) == 1
    assert run(spark, path, range(6), 2) == {"rows": 3, "watermark": DAY[5], "attempt": 1}
    assert ids() == list(range(6))
    # Run 2 again, with rows that came late: replaced, from the same watermark.
    assert run(spark, path, range(8), 2) == {"rows": 5, "watermark": DAY[7], "attempt": 2}
    assert ids() == list(range(8))
    assert run(spark, path, range(8), 3) == {"rows": 0, "watermark": DAY[7], "attempt": 1}
    marks = {r.process_id: (r.attempt, r.target_count, r.last_incremental) for r in publish.manifests(spark, path).collect()}
    assert marks == {1: (1, 3, DAY[2]), 2: (2, 5, DAY[7]), 3: (1, 0, DAY[7])}
    assert publish.watermark(spark, path, "g", "other", 9, FIRST) == FIRST


def test_sql_task(spark):
    spark.createDataFrame([(i, DAY[i], "o'neil" if i % 2 else "x") for i in range(10)], "id int, t timestamp_ntz, who string").createOrReplaceTempView("t_task")
    hostile = "o'neil' OR 1 = 1; DROP VIEW t_task; --"
    params = {"source": "t_task", "watermark": DAY[3], "who": "o'neil", "unused": 1}
    prepare = "BEGIN SET output_date = (SELECT max(t) FROM IDENTIFIER(:source) WHERE t > :watermark); END"
    query = "SELECT id FROM IDENTIFIER(:source) WHERE t > :watermark AND t <= :output_date AND who = :who -- :comment"
    rows, mark = sql_tasks.run_sql(spark, query, params, prepare)
    assert sorted(r.id for r in rows.collect()) == [5, 7, 9] and mark == DAY[9]
    rows, mark = sql_tasks.run_sql(spark, query.replace(" AND t <= :output_date", ""), {**params, "who": hostile})
    assert rows.count() == 0 and mark is None and spark.table("t_task").count() == 10
    with pytest.raises(KeyError, match="watermark"):
        sql_tasks.run_sql(spark, query, {"source": "t_task"})
    assert sql_tasks.markers("SELECT ':no', `:x`, :yes, a::int, 'it''s :no' /* :no */ -- :no\n, :also") == {"yes", "also"}
    assert sql_tasks.parameter_rows(spark, "SELECT who, min(id) AS file_name_part FROM t_task WHERE id < :n GROUP BY who", {"n": 4}).count() == 2


def test_collated_columns(spark):
    df = spark.createDataFrame([("Ab ", 1), ("AB", 2), ("ab  ", 3), (" ab", 4), (None, 5), ("É", 6), ("é ", 7)], "k string, v int")
    groups = lambda **kw: sorted(map(sorted, (r.v for r in collation.collate_columns(df, ["k"], **kw).groupBy("k").agg(
        F.collect_list("v").alias("v")).collect())))
    assert groups() == [[1, 2, 3], [4], [5], [6, 7]]
    assert groups(ignore_case=False) == [[1], [2], [3], [4], [5], [6], [7]]
    assert groups(ignore_trailing=False) == [[1], [2], [3], [4], [5], [6], [7]]
    both = collation.collate_columns(df, ["k"])
    assert sorted(r.v for r in both.where(F.col("k").isin("aB", "x")).collect()) == [1, 2, 3]
    assert both.alias("a").join(both.alias("b"), "k").count() == 9 + 1 + 4
    assert both.select("k").distinct().count() == 4 and collation.plain_columns(both, ["k"]).select("k").distinct().count() == 7
    assert "SortMergeJoin" in (p := both.alias("a").hint("merge").join(both.alias("b"), "k")._jdf.queryExecution().toString()) and "Cartesian" not in p


def test_list_of_a_hot_key(spark):
    random_ = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 9}", random_.randrange(50), random_.choice(["a", "b", None])) for i in range(6000)] + [("none", 1, None), (None, 1, "x")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(5)
    for descending in (False, True):
        args = (["k"], "v", ["o"], "l", ";", descending, "")
        a, b = (sorted(map(tuple, f(df, *args).collect()), key=str) for f in (aggregates.list_ordered, aggregates.list_ordered_blocks))
        assert a == b and ("none", "") in a
    blocks = df.select("k", "o").repartitionByRange(8, "k", "o").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert blocks < 3000  # the hot key's 4,000 rows are dealt out


def test_ordered_output(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("id")).repartition(7)
    path = work_path(spark, "t-ordered")
    ordered.write_ordered(df, F.concat(F.lit("line "), "id"), ["id"], path, files=5)
    assert len(glob.glob(f"{path.removeprefix('file:')}/part-*")) > 1
    assert [r.value for r in ordered.read_ordered(spark, path).orderBy("line_no").collect()] == [f"line {i}" for i in range(3000)]
    text = "".join(open(f, newline="").read() for f in sorted(glob.glob(f"{path.removeprefix('file:')}/part-*")))
    assert text == "".join(f"line {i}\r\n" for i in range(3000))
    empty = work_path(spark, "t-ordered")
    ordered.write_ordered(df.where("id < 0"), F.col("id").cast("string"), ["id"], empty)
    assert ordered.read_ordered(spark, empty).count() == 0


def test_survey_stream_keeps_its_keys_as_state(spark, tmp_path):
    """Repeats of one load stay, keys of the table are known from the start, NULL keys never match, and a later batch reads no table."""
    folder, target, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    folder.mkdir()

    def drop(name, rows):
        (folder / name).write_text("surveyid|Program Name|question_id|answer_txt\n" + "".join("|".join(r) + "\n" for r in rows))
    drop("a.csv", [("1", "P", "7", f"x{i}") for i in range(12_000)] + [("2", "P", "1", "y"), ("", "P", "5", "no id")])
    survey.load_stream(spark, str(folder), target, state, "*.csv")
    assert spark.read.parquet(target).count() == 12_002
    for f in glob.glob(f"{target}/stream=*/batch=*/*.parquet"):
        open(f, "wb").write(b"unreadable")
    drop("b.csv", [("1", "P", "7", "late"), ("3", "P", "1", "new"), ("3", "P", "1", "new too"), ("", "P", "5", "no id")])
    survey.load_stream(spark, str(folder), target, state, "*.csv")
    fresh = spark.read.parquet(*[p for p in glob.glob(f"{target}/stream=*/batch=*") if not p.endswith("batch=0")])
    assert sorted(r.answer_txt for r in fresh.collect()) == ["new", "new too", "no id"]


def test_survey_stream_asks_its_state_by_bucket():
    """A call between Spark and Python serves every key of a bucket, however the rows of the call are cut."""
    import numpy as np
    import pandas as pd
    from wardflow.streaming.survey import KEYS, NewAnswers

    class State:
        def __init__(self):
            self.rows, self.calls = [], 0

        def get(self):
            self.calls += 1
            return iter(self.rows)

        def appendList(self, rows):
            self.calls += 1
            self.rows += rows

    class Handle:
        def __init__(self):
            self.state = State()

        def getListState(self, name, schema):
            return self.state

    def load(processor, parts):
        return [tuple(r) for p in processor.handleInputRows((0,), iter(parts), None) for r in p.itertuples(index=False)]

    processor, handle = NewAnswers(), Handle()
    processor.init(handle)
    processor.handleInitialState((0,), pd.DataFrame([(5, "1")], columns=KEYS), None)
    frame = lambda rows: pd.DataFrame(rows, columns=[*KEYS, "answer_txt"])
    parts = [frame([(i, "1", "a") for i in range(10)]), frame([(np.nan, "1", "b"), (3, "1", "again"), (5, "1", "late"), (7, None, "c")])]
    got = load(processor, parts)
    assert len(got) == 9 + 3 and handle.state.calls == 3
    assert sorted(handle.state.rows) == [(i, "1") for i in range(10)]
    late = load(processor, [frame([(3, "1", "late"), (np.nan, "1", "b"), (11, "1", "new")])])
    assert [r[2] for r in late] == ["b", "new"]


def test_staged_copies_go_with_their_block(spark, tmp_path):
    from wardflow.session import materialise, shared_dir, staging
    root = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    left = lambda: sorted(glob.glob(f"{root}/t-staged-*"))
    with staging(spark):
        with staging(spark):
            inner = materialise(spark, spark.range(5), "t-staged")
            assert inner.count() == 5 and len(left()) == 1
        kept = materialise(spark, spark.range(7), "t-staged")
        assert kept.count() == 7 and len(left()) == 1 and not glob.glob(f"{left()[0]}/_SUCCESS")
        with pytest.raises(RuntimeError):
            with staging(spark):
                materialise(spark, spark.range(1), "t-staged")
                raise RuntimeError
        assert len(left()) == 1
    assert left() == []
