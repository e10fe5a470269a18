"""The registered queries over their tables, and the pipeline."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
import oracle
from wardflow.llm import queries
from wardflow.session import work_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    ok, text = oracle.compare(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.ORACLE[name])
    assert ok, text


def test_one_query_for_each_operator():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE) - {"op6_multi_index"}))
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = queries.QUERIES[name](spark, SF)
    assert out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0 and out.count() == docs.count()


def test_pipeline_stages(spark, edge, none, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "pii", "mixing", "bpe"]
    labels = spark.createDataFrame([(1, 1, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edge, none, spark.read.parquet(f"{SF}/documents.parquet")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name == "bpe":
                assert out.columns[:2] == ["doc_id", "n_tokens"] and out.count() == docs.count()
            else:
                assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
                path = work_path(spark, "t-stage")
                out.write.parquet(path)
                docs = spark.read.parquet(path)
