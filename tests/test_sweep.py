"""Several as-of questions in one placement."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators.sweep import BACK, FORWARD, Ask, sweep

T0 = dt.datetime(2025, 1, 1)


def test_sweep_equals_a_search(spark):
    """A hot key, equal instants, missing times and keys, categories that no question asks for."""
    random_ = random.Random(9)
    at = lambda n: None if random_.random() < 0.03 else T0 + dt.timedelta(hours=random_.randrange(n))
    events = [(i, random_.choice(["hot", "hot", "a", "b", None]), at(300), random_.choice("xyzw")) for i in range(1500)]
    probes = [(i, random_.choice(["hot", "a", "b", "none", None]), at(300), at(300)) for i in range(200)]
    e = spark.createDataFrame(events, "id int, k string, t timestamp_ntz, c string").repartition(5)
    p = spark.createDataFrame(probes, "pid int, k string, s timestamp_ntz, f timestamp_ntz").repartition(3)
    asks = [Ask("before", "s", BACK, ("x", "y")), Ask("after", "f", FORWARD, ("x", "z")), Ask("next", "s", FORWARD, ("z",))]
    got = sorted(map(tuple, sweep(p, e, asks, probe="pid", key="k", event_time="t", event="id", category="c").collect()))
    want = []
    for a in asks:
        for pid, k, s, f in probes:
            time = s if a.time == "s" else f
            for c in a.categories:
                hits = [(t, i) for i, ek, t, ec in events if k and ek == k and t and time and ec == c and (t <= time if a.direction == BACK else t >= time)]
                if hits:
                    want.append((pid, a.name, c, (max if a.direction == BACK else min)(hits)[1]))
    assert got == sorted(want) and len(got) > 300


@pytest.mark.parametrize("blocks", [1, 40])
def test_sweep_over_many_blocks(spark, monkeypatch, blocks):
    """Blocks that split a hot (key, category) hand their picks on."""
    from wardflow.operators import sweep as module
    from wardflow.session import materialise

    def cut(df, order, label):
        rows = df.repartitionByRange(blocks, *[F.col(c).asc_nulls_first() for c in order])
        return materialise(df.sparkSession, rows.withColumn("_block", F.spark_partition_id()), label)
    monkeypatch.setattr(module, "placed", cut)
    events = [(i, "hot", T0 + dt.timedelta(hours=i * 7 % 500), "xy"[i % 50 == 0]) for i in range(500)]
    probes = [(i, "hot", T0 + dt.timedelta(hours=i * 3 - 20)) for i in range(190)]
    e = spark.createDataFrame(events, "id int, k string, t timestamp_ntz, c string")
    p = spark.createDataFrame(probes, "pid int, k string, s timestamp_ntz")
    asks = [Ask("b", "s", BACK, ("x", "y")), Ask("f", "s", FORWARD, ("x", "y"))]
    got = sorted(map(tuple, sweep(p, e, asks, probe="pid", key="k", event_time="t", event="id", category="c").collect()))
    want = []
    for a in asks:
        for pid, _, s in probes:
            for c in "xy":
                hits = [(t, i) for i, _, t, ec in events if ec == c and (t <= s if a.direction == BACK else t >= s)]
                if hits:
                    want.append((pid, a.name, c, (max if a.direction == BACK else min)(hits)[1]))
    assert got == sorted(want)


def test_no_text_in_a_window_and_one_placement(spark, monkeypatch):
    """The registry places its results once, and windows carry ids only."""
    from wardflow.operators import sweep as module
    from wardflow.plans import registry
    placed_columns = []
    original = module.placed
    monkeypatch.setattr(module, "placed", lambda df, order, label: placed_columns.append(df.columns) or original(df, order, label))
    labs = spark.createDataFrame([(1, "lab", "bun", "long text", 7, T0, 1)], "patient_key long, family string, category string, shown string, order_id long, collected timestamp_ntz, result_key long")
    index = spark.createDataFrame([(5, 1, T0, T0, T0)], "case_key long, patient_key long, procedure_start timestamp_ntz, procedure_complete timestamp_ntz, start_day timestamp_ntz")
    picks = registry.lab_picks(index, labs)
    assert sorted((r.ask, r.category, r.shown, r.order_id) for r in picks.collect()) == [("after", "lab:bun", "long text", 7), ("before", "lab:bun", "long text", 7)]
    assert placed_columns == [["_k", "_t", "_cat", "_low", "_high", "_rank"]]  # ids, times and categories
    plan = picks._jdf.queryExecution().optimizedPlan().toString()
    assert not any("shown" in line for line in plan.splitlines() if "Window" in line)
    assert picks.agg(F.count("*")).first()[0] == 2


@pytest.mark.parametrize("rows", [None, 40])
def test_columns_of_picked_events(spark, monkeypatch, rows):
    """Texts are joined where the ids lie; keys cut into parts hand ids and texts on, repeated ids and NULL ids included."""
    from wardflow.operators import sweep as module
    from wardflow.session import in_place, materialise
    if rows:
        monkeypatch.setattr(module, "PART_ROWS", rows)
    random_ = random.Random(4)
    at = lambda n: None if random_.random() < 0.03 else T0 + dt.timedelta(hours=random_.randrange(n))
    events = [(None if i == 77 else f"e{i:04d}", random_.choice(["hot", "hot", "hot", "a", None]), at(200), random_.choice("xyzw" if i % 9 else "v"), f"text {i}") for i in range(700)]
    probes = [(i, random_.choice(["hot", "a", "none", None]), at(200), at(200)) for i in range(150)]
    e = spark.createDataFrame(events, "id string, k string, t timestamp_ntz, c string, text string").repartition(5)
    p = spark.createDataFrame(probes, "pid int, k string, s timestamp_ntz, f timestamp_ntz").repartition(3)
    asks = [Ask("before", "s", BACK, ("x", "v")), Ask("after", "f", FORWARD, ("x", "v", "z")), Ask("next", "s", FORWARD, ("z",))]
    found = sweep(p, e, asks, probe="pid", key="k", event_time="t", event="id", category="c", carry=["text"])
    assert found.columns == ["probe", "ask", "category", "event", "k", "text"]
    with in_place(spark):
        got = sorted(map(tuple, materialise(spark, found, "found").collect()))
    want = []
    for a in asks:
        for pid, k, s, f in probes:
            time = s if a.time == "s" else f
            for c in a.categories:
                hits = [(t, i, x) for i, ek, t, ec, x in events if i and k and ek == k and t and time and ec == c and (t <= time if a.direction == BACK else t >= time)]
                if hits:
                    _, i, x = (max if a.direction == BACK else min)(hits)
                    want.append((pid, a.name, c, i, k, x))
    assert got == sorted(want) and len(got) > 300


def test_picks_are_sent_neither_to_their_texts_nor_to_their_cases(spark):
    """Events and probes are exchanged once, texts once; the rows of picks and the row of a case are made where they lie."""
    from wardflow.session import in_place
    e = spark.createDataFrame([(i, i % 7, T0 + dt.timedelta(hours=i), "xy"[i % 2], f"t{i}") for i in range(200)], "id int, k int, t timestamp_ntz, c string, text string")
    p = spark.createDataFrame([(i, i % 7, T0 + dt.timedelta(hours=3 * i)) for i in range(60)], "pid int, k int, s timestamp_ntz")
    asks = [Ask("b", "s", BACK, ("x", "y")), Ask("f", "s", FORWARD, ("x", "y"))]
    found = sweep(p, e, asks, probe="pid", key="k", event_time="t", event="id", category="c", carry=["text"])
    with in_place(spark):
        wide = found.groupBy("k", "probe").agg(F.max("text"))
        plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange") == 2
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
