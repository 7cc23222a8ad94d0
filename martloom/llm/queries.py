"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import (
    conversations,
    decontaminate,
    licenses,
    mixing,
    ngram_join,
    periodic_runs,
    pii,
    quality,
    quality_rules,
    secret_scan,
    token_counts,
    topk,
    toxicity,
)
from martloom.llm.common import table
from martloom.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op4_mix_sources": mixing.ORACLE,
    "op9_top_k": topk.ORACLE,
    "op11_quality_rules": quality_rules.ORACLE,
}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@cache
def encoder(name: str = "byte_bpe_50k.json") -> token_counts.Encoder:
    """The named public tokenizer file, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return token_counts.Encoder(file.read(), public_tokenizers.PATTERN)


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), path="source")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_documents(table(spark, sf_dir, "documents"), encoder())


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.mask_report(table(spark, sf_dir, "documents"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(table(spark, sf_dir, "conversations"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
