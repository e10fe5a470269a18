"""Quality rules, near duplicates, pseudonyms, mixing and token ids over ``documents``, one stage after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.llm import line_rules, mixing, ngram_join, pseudonyms, transducer_bpe
from wardflow.llm.common import importable
from wardflow.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limit of their host leave the kept ones."""
    return line_rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of smallest doc_id."""
    return ngram_join.first_of_each(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers and dates become pseudonyms of the same format."""
    return pseudonyms.pseudonymise_text(docs, pseudonyms.deployment_key(spark))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate for the target mixture says."""
    return mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the digests of ids and decoded text."""
    import public_tokenizers

    return transducer_bpe.round_trip_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", pii),
    ("mixing", mixture),
    ("bpe", token_ids),
]

#: SQL can't express the n-gram join's components or the token ids; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result but the last is written to the shared folder and read again."""
    importable(spark)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        df = materialise(spark, stage(spark, df, sf_dir), name)
    return STAGES[-1][1](spark, df, sf_dir)
