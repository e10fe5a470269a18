"""The operators over their whole tables, one query each, with oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (line_rules, merkle_log, mixing, multi_index, ngram_join, perspectives, pseudonyms, radix_repeats, repeats, site_quality, skyband_audit,
               toxicity, transducer_bpe)
from .common import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` with its oracle SQL."""
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op4_line_frequency", line_rules.ORACLE)
def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document; the host is its source."""
    return line_rules.line_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "line_chars", "lost_chars")


@query("op1_bpe_round_trip")
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Digests of the token ids of every text and of the text decoded from them."""
    import public_tokenizers

    return transducer_bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))


@query("op7_pseudonyms")
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers and dates permuted within their formats."""
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), pseudonyms.deployment_key(spark))


@query("op2_repeats")
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document when passages of 20 words that occur earlier are removed."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query("op9_ngram_join")
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles overlap by 80 % or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document and its worst sentence."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op6_multi_index")
def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest vectors of every twentieth vector."""
    return multi_index.search(table(spark, sf_dir, "embeddings"))


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and sampling rate of every document."""
    return mixing.document_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row_hash")


@query("op5_perspectives", perspectives.ORACLE)
def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the view of each participant."""
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return perspectives.rotate(table(spark, sf_dir, "conversations")).withColumn("mask", spans).drop("messages")


@query("op10_site_quality")
def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality posterior of every document from its text, host and path."""
    return site_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_merkle_log", merkle_log.oracle_sql())
def op13_merkle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its possibly tampered row still verifies."""
    return merkle_log.manifest(table(spark, sf_dir, "documents"))


@query("op12_skyband_audit", skyband_audit.ORACLE)
def op12_skyband_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of a language, and the words that set each source off."""
    return skyband_audit.audit(table(spark, sf_dir, "documents"))


@query("op11_radix_repeats")
def op11_radix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document when all strings of 200 bytes that occur elsewhere are removed."""
    return radix_repeats.remove_repeated_bytes(table(spark, sf_dir, "documents"))
