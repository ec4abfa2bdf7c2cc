"""A training corpus from raw documents: five stages, each written before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dispatchlens.llm import decontamination, language_id, mixing, near_dedup, token_output
from dispatchlens.plans.shared import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determinable language go.

    The model is learnt from the labelled documents outside the held-out quarter.
    """
    model = language_id.learn(docs.where(~language_id.held_out()))
    return language_id.accepted(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, 0.8)."""
    return near_dedup.dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes, in the order of training."""
    return mixing.curriculum(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encoded segments are written; the table of documents is read back from them."""
    path = fresh_path(spark, "pipeline-tokens")
    token_output.write(docs, path, token_output.default_tokenizer())
    return token_output.read(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

# The stages learn, sketch and encode; no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            path = fresh_path(spark, f"pipeline-{position}-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
