"""The cohort's filter in the scan of a fact table."""

import pytest
from pyspark.sql import functions as F

from wardflow.operators.cohort import Cohort, filter_bits


def test_rows_behind_the_scan_fall_with_the_cohort(spark):
    fact = spark.range(200_000).select((F.col("id") % 50_000).alias("k"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([(None, -1)], "k long, v long"))
    for step, most in ((50, 8_000), (5, 46_000)):
        cohort = Cohort(spark.range(0, 50_000, step).withColumnRenamed("id", "k"), "k")
        exact = cohort.of(fact)
        passed = fact.where(cohort.may_hold(F.col("k")))
        assert exact.count() == 4 * 50_000 // step == exact.where(f"k % {step} = 0").count()
        assert 4 * 50_000 // step <= passed.count() <= most  # what is left for an exchange
        plan = exact._jdf.queryExecution().executedPlan().toString()
        assert plan.index("getbit") > plan.index("Join")  # the condition stands below the join, on the scan's side
        assert exact.columns == ["k", "v"]


def test_a_cohort_that_would_fill_the_filter_gets_none(spark):
    assert filter_bits(80) == 1024 and filter_bits(2_000_000) == 1 << 23 and filter_bits(3_000_000) is None
    cohort = Cohort(spark.range(5000).withColumnRenamed("id", "k"), "k", max_bits=4096)
    assert cohort.bits is None and cohort.of(spark.range(10_000), "id").count() == 5000


@pytest.mark.parametrize("keys", [[], [None], [3, 3, None]])
def test_small_cohorts(spark, keys):
    cohort = Cohort(spark.createDataFrame([(k,) for k in keys], "k long"), "k")
    assert [r.id for r in cohort.of(spark.range(10), "id").collect()] == [k for k in dict.fromkeys(keys) if k is not None]
