"""Training-data pipeline over ``documents``: each stage reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import decontaminate, mixing, ngram_join, pii, toxicity
from martloom.llm.common import table
from martloom.session import materialize, prepare


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from ``labels``, lets pass."""
    return toxicity.drop_toxic(docs, table(prepare(spark), sf_dir, "labels"))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(prepare(spark), sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms."""
    prepare(spark)
    return pii.mask_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with how often (``copies``)."""
    prepare(spark)
    return mixing.apply_mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", keep_one_of_group),
    ("decontamination", drop_leaks),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
]
ORACLE_SQL = None  # a trained model decides the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
