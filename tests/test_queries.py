"""Every registered query against its oracle SQL on the smallest tables, and report invariants."""

import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


#: Checked by brute force in tests/llm instead, where that folder exists.
LLM = {n for n in QUERIES if n == "pipeline" or n.startswith("op") and n[2].isdigit()}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - LLM == set(SQL) - LLM


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LLM))
def test_query_matches_oracle(spark, duck, name):
    ok, text = oracle.compare(QUERIES[name](spark, SF), duck, SQL[name])
    assert ok, text


def test_entry_runs(spark):
    assert entry.entry(spark).count() == spark.read.parquet(f"{SF}/orders.parquet").count()


@pytest.mark.parametrize("name", ["registry_wide", "comorbidity_cohort", "datamart_wide"])
def test_one_row_per_case(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() == df.select("case_key").distinct().count() > 0


@pytest.mark.parametrize("name", ["asof_backward", "followup_buckets", "lead_next", "billing_roster"])
def test_same_rows_with_one_partition(spark, duck, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        ok, text = oracle.compare(QUERIES[name](spark, SF), duck, SQL[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ok, text


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["day_between"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    plan = QUERIES["latest_per_key"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan
