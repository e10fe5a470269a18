"""Follow-up buckets: plan and results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardflow.operators import followup


def test_followup_buckets_exchanges_its_cells_once(spark):
    """One exchange of the cells, none after the join of the years; weeks over New Year, alike cases and NULLs come out right."""
    day = lambda s: dt.datetime.fromisoformat(s)
    cases = spark.createDataFrame(
        [(1, 7, day("2024-12-24 10:00")), (1, 7, day("2024-12-24 10:00")), (2, 7, day("2024-12-24 10:00")), (3, 7, day("2024-12-31 08:00")),
         (4, None, day("2024-12-24")), (5, 7, None), (None, 7, day("2024-12-24 10:00"))], "id long, k long, t0 timestamp_ntz")
    results = spark.createDataFrame(
        [(7, "c", day(t), i) for i, t in enumerate(["2024-12-30 09:00", "2025-01-03 09:00", "2024-12-31 07:00", "2025-01-08 09:00", "2025-01-20 09:00",
                                                     "2025-03-05 09:00", "2025-06-05 09:00", "2025-11-05 09:00", "2027-01-01 01:00", "2028-02-01 01:00"])]
        + [(None, "c", day("2025-01-01"), 99), (7, "c", None, 98)], "k long, c string, t timestamp_ntz, v long")
    ask = dict(key="k", index_time="t0", component="c", time="t", values=["v"], tiebreak=["v"])
    got = followup.followup_buckets(cases, results, carry=["id"], **ask)
    rows = sorted(((r.id, r.bucket, r.v) for r in got.collect()), key=str)
    early, late = [("w1", 1), ("m1", 4), ("m3", 5), ("m6", 6), ("y1", 7), ("ygt1", 9)], [("w1", 3), ("m1", 4), ("m3", 5), ("m6", 6), ("y1", 7), ("ygt1", 9)]
    assert rows == sorted([(i, *p) for i in (1, 1, 2, None) for p in early] + [(3, *p) for p in late], key=str)
    # The same without carried columns, by brute force over buckets.
    plain = followup.followup_buckets(cases, results, **ask)
    pairs = cases.join(results, "k").where("t0 IS NOT NULL AND t IS NOT NULL").withColumn("bucket", followup.bucket_of("t0", "t")).where("bucket IS NOT NULL")
    want = pairs.groupBy("k", "t0", "c", "bucket").agg(F.max_by("v", F.struct("t", "v")).alias("v"), F.max("t").alias("time"))
    cols = ["k", "t0", "c", "bucket", "time", "v"]
    assert plain.select(cols).exceptAll(want.select(cols)).count() == 0 and plain.count() == want.count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = followup.followup_buckets(cases, results, carry=["id"], **ask)
        joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert final.count("ReusedExchange") >= 1 and "bucket" not in "".join(x for x in final.splitlines() if "Exchange hashpartitioning" in x)
