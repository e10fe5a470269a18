import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators import aggregates, asof, followup, intervals, joins, picks
from wardflow.plans import cohort

BASE = dt.datetime(2020, 1, 1)


def times(rng, n):
    return [BASE + dt.timedelta(hours=rng.choice([0, 6, 12]), days=rng.randrange(900)) for _ in range(n)]


@pytest.fixture(scope="module")
def matched(spark):
    """Events and probes with one hot key, one hot instant and NULLs."""
    rng = random.Random(1)
    events = [(rng.choice([1, 1, 1, 2, 3]), t, rng.choice("xyz"), i, rng.choice([None, i % 7])) for i, t in enumerate(times(rng, 400))]
    events += [(1, BASE, "x", 1000 + i, 5) for i in range(60)] + [(None, BASE, "x", 5000, 1), (2, None, "y", 5001, 1)]
    probes = [(i, rng.choice([1, 1, 2, 3, 4]), t) for i, t in enumerate(times(rng, 150))] + [(900, None, BASE), (901, 1, None), (902, 1, BASE), (903, 1, BASE)]
    e = spark.createDataFrame(events, "k int, t timestamp_ntz, c string, id int, v int")
    p = spark.createDataFrame(probes, "pid int, k int, t timestamp_ntz")
    return events, probes, e, p


def brute(events, probe, cat, back, inclusive):
    _, k, t = probe
    if k is None or t is None:
        return None
    ok = [e for e in events if e[0] == k and e[1] is not None and e[2] == cat and (
        (e[1] < t if back else e[1] > t) or (inclusive and e[1] == t))]
    if not ok:
        return None
    best = max(ok, key=lambda e: (e[1], e[3])) if back else min(ok, key=lambda e: (e[1], e[3]))
    return (best[1], best[4], best[3])


@pytest.mark.parametrize("direction,inclusive", [("backward", True), ("backward", False), ("forward", True), ("forward", False)])
def test_asof_against_brute_force(matched, small_blocks, direction, inclusive):
    events, probes, e, p = matched
    got = asof.asof(p, e, key="k", left_time="t", right_time="t", values=["v", "id"], tiebreak=["id"], direction=direction,
                    inclusive=inclusive, category="c", categories={"x": "cx", "y": "cy"})
    rows = {r.pid: r for r in got.collect()}
    assert len(rows) == len(probes) == got.count()
    for probe in probes:
        for cat in "xy":
            want = brute(events, probe, cat, direction == "backward", inclusive)
            have = rows[probe[0]][f"c{cat}"]
            assert (None if have is None else tuple(have)) == want, (probe, cat)


def test_nearest_against_brute_force(matched, small_blocks):
    events, probes, e, p = matched
    got = asof.nearest(p, e, key="k", left_time="t", right_time="t", values=["id"], tiebreak=["id"])
    for r in got.collect():
        ok = [x for x in events if r.k is not None and r.t is not None and x[0] == r.k and x[1] is not None]
        want = min(ok, key=lambda x: (abs(x[1] - r.t), x[1], x[3]))[3] if ok else None
        assert (r.near.id if r.near else None) == want


def test_nearest_example(spark):
    day = dt.datetime(2020, 9, 17)
    left = spark.createDataFrame([(1, day.replace(minute=45))], "k int, t timestamp_ntz")
    right = spark.createDataFrame([(1, day.replace(hour=1), 82), (1, day.replace(hour=9), 389)], "k int, at timestamp_ntz, line int")
    got = asof.nearest(left, right, key="k", left_time="t", right_time="at", values=["line"], tiebreak=["line"]).first()
    assert got.near.line == 82


def test_next_row_is_lead(spark, small_blocks):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, BASE, BASE + dt.timedelta(days=rng.randrange(5))]), i, f"s{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, id int, s string")
    got = {r.id: (r.nt, r.ns) for r in picks.next_row(df, ["k"], ["t", "id"], {"nt": "t", "ns": "s"}).collect()}
    df.createOrReplaceTempView("lead_rows")
    want = spark.sql("select id, lead(t) over w nt, lead(s) over w ns from lead_rows window w as (partition by k order by t nulls first, id)")
    assert got == {r.id: (r.nt, r.ns) for r in want.collect()}


@pytest.fixture
def small_blocks(spark):
    """Small tables are one block unless Spark keeps its partitions apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_hot_key_is_cut_into_even_blocks(spark, small_blocks):
    # One key, all times inside one day and all distinct.
    df = spark.range(8_000).selectExpr("1 AS k", "id", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS t")
    sizes = [r["count"] for r in picks.placed(df, ["k", "t"], "t-blocks").groupBy("_block").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 8_000 / 3
    got = picks.next_row(df, ["k"], ["t", "id"], {"after": "id"})
    assert got.where("after = id + 1").count() == 7_999 and got.where("after IS NULL").count() == 1
    probes = df.where("id % 1000 = 500").selectExpr("k", "id AS pid", "t")
    back = asof.asof(probes, df.where("id % 4000 = 0"), key="k", left_time="t", right_time="t", values=["id"], tiebreak=["id"])
    assert {r.pid: r.pick.id for r in back.collect()} == {i: i // 4000 * 4000 for i in range(500, 8000, 1000)}


def test_count_per_keeps_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert sorted((str(r.k), r.n) for r in picks.count_per(df, ["k"], "n").collect()) == [("1", 2), ("1", 2), ("2", 1), ("None", 1)]


def test_null_order_of_latest(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5, 2)], "k int, t int, id int")
    assert picks.latest_per(df, ["k"], "t", ["id"], nulls_first=True).first().id == 1
    assert picks.latest_per(df, ["k"], "t", ["id"]).first().id == 2


def test_row_number_pick_is_limited_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("id % 3 k", "id")
    plan = picks.latest_per(df, ["k"], "id", [])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning"):]
    assert "Partial" in before and "WindowGroupLimit" in before


def test_anti_append(spark):
    target = spark.createDataFrame([(1, "23")], "a int, b string")
    stage = spark.createDataFrame([(12, "3"), (1, "23"), (2, "x")], "a int, b string")

    def rows(df):
        return sorted((r.a, r.b) for r in df.collect())
    assert rows(joins.anti_append(stage, target, ["a", "b"])) == [(2, "x"), (12, "3")]
    assert rows(joins.anti_append_legacy(stage, target, ["a", "b"])) == [(2, "x")]
    with_null = target.union(spark.createDataFrame([(None, "q")], "a int, b string"))
    assert rows(joins.anti_append_legacy(stage, with_null, ["a", "b"])) == []
    assert rows(joins.anti_append(stage, with_null, ["a", "b"])) == [(2, "x"), (12, "3")]


def test_lists(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "b", 1), (2, None, 1), (1, "c", 0)], "k int, v string, o int")
    ordered = {r.k: r.l for r in aggregates.list_ordered(df, ["k"], "v", ["o"], "l").collect()}
    assert ordered == {1: "c,b,b,a", 2: None}
    assert {r.k: r.l for r in aggregates.list_ordered(df, ["k"], "v", ["o"], "l", empty="").collect()}[2] == ""
    assert {r.k: r.l for r in aggregates.list_distinct(df, ["k"], {"l": "v"}).collect()} == {1: "a || b || c", 2: None}


def test_trailer_without_detail(spark):
    cols = ["subscriber_id", "first_name", "last_name", "status"]
    members = spark.createDataFrame([("1", "a", "b", "Y")], ", ".join(f"{c} string" for c in cols))
    got = aggregates.header_detail_trailer(members.where("false"), members, "20250401", cols).collect()
    assert [(r.record_order, r.subscriber_id, r.last_name) for r in got] == [(3, "TR", "0")]
    assert aggregates.header_detail_trailer(members.where("false"), members.where("false"), "x", cols).count() == 0
    full = aggregates.header_detail_trailer(members, members, "20250401", cols).orderBy("record_order").collect()
    assert [r.subscriber_id for r in full] == ["HR", "1", "TR"] and full[2].last_name == "1"


def test_interval_join_against_brute_force(spark):
    rng = random.Random(3)
    d0 = dt.date(2020, 1, 1)
    left = [(i, rng.choice([1, 1, 2]), d0 + dt.timedelta(days=rng.randrange(300))) for i in range(80)]
    right = [(i, rng.choice([1, 1, 2, 3]), d0 + dt.timedelta(days=rng.randrange(300))) for i in range(80)]
    for lo, hi in ((1, 30), (31, 90), (0, 10), (0, 0), (-5, 3)):
        got = intervals.interval_join(spark.createDataFrame(left, "i int, k int, a date"), spark.createDataFrame(right, "j int, k int, b date"),
                                      key="k", left_date="a", right_date="b", lo=lo, hi=hi)
        want = sorted((i, j) for i, k, a in left for j, k2, b in right if k == k2 and lo <= (b - a).days <= hi)
        assert sorted((r.i, r.j) for r in got.collect()) == want


def test_readmission_lists_borders(spark):
    d = dt.date(2020, 1, 1)
    index = spark.createDataFrame([(1, d)], "k int, index_day date")
    days = [0, 1, 30, 31, 90, 91]
    adm = spark.createDataFrame([(1, d + dt.timedelta(days=n), f"r{n}") for n in days], "k int, day date, reason string")
    got = cohort.readmission_lists(index, adm, "k").first()
    assert got.reasons_30 == "r1, r30" and got.reasons_90 == "r31, r90" and got.dates_30 == "2020-01-02, 2020-01-31"


def test_followup_against_brute_force(spark):
    rng = random.Random(4)
    cases = [(i, rng.choice([1, 1, 2]), t) for i, t in enumerate(times(rng, 40))]
    results = [(rng.choice([1, 1, 2]), rng.choice("ab"), t, i) for i, t in enumerate(times(rng, 500))]
    c = spark.createDataFrame(cases, "cid int, k int, t0 timestamp_ntz")
    r = spark.createDataFrame(results, "k int, c string, t timestamp_ntz, id int")
    got = followup.followup_buckets(c, r, key="k", index_time="t0", component="c", time="t", values=["id"], tiebreak=["id"])
    c.createOrReplaceTempView("fu_cases")
    r.createOrReplaceTempView("fu_results")
    pairs = c.join(r, "k").where("t >= t0").withColumn("bucket", followup.bucket_of("t0", "t")).where("bucket is not null")
    want = picks.latest_per(pairs.select("k", "t0", "c", "bucket", "t", "id").distinct(), ["k", "t0", "c", "bucket"], "t", ["id"])
    key = lambda x: (x.k, x.t0, x.c, x.bucket, x.id)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_condition_flags(spark):
    codes = [("I50.9", None), ("E11.9", None), ("E11.21", None), ("G47.33", None), ("Z00", "Obstructive SLEEP apnea"), ("428.0", None), (None, "x")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(codes)], "diagnosis_key int, value string, display string")
    from wardflow.operators.code_flags import flag_columns
    rows = cohort.condition_masks(spark, df).select("diagnosis_key", *flag_columns(cohort.FLAGS)).collect()
    on = {r.diagnosis_key: {f for f in cohort.FLAGS if r[f]} for r in rows}
    assert on == {0: {"chf"}, 1: {"dm"}, 2: {"dm", "dmcx"}, 3: set(), 4: {"osa_flag"}, 5: {"chf"}, 6: set()}
    icd9 = cohort.condition_flags({
        "diagnosis_code": df.select("diagnosis_key", F.lit("ICD-9-CM").alias("type"), "value", "display"),
        "diagnosis_event": df.select(F.lit(1).alias("patient_key"), "diagnosis_key", F.lit(1).alias("count"), F.lit("Encounter Diagnosis").alias("type"))},
        spark.createDataFrame([(1,)], "patient_key int"))
    assert icd9.count() == 0


def test_later_days(spark):
    d = dt.date(2020, 5, 1)
    left = spark.createDataFrame([(1, d), (1, None), (2, d)], "k int, a date")
    right = spark.createDataFrame([(1, d + dt.timedelta(days=n)) for n in (0, 3, 3, 1)], "k int, b date")
    got = intervals.later_days(left, right, key="k", left_date="a", right_date="b", out="l", descending=True).collect()
    assert sorted(str(r.l) for r in got) == ["2020-05-04,2020-05-02", "None", "None"]


def test_slot_pivot(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (1, 4, "z"), (2, 3, "d")], "k int, line int, v string")
    got = aggregates.slot_pivot(df, ["k"], "line", ["v"], {"v": "v"}, {1: "p", 2: "s", 3: "t"}).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", "b", None), (2, None, None, "d")]
