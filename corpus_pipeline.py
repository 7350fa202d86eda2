"""Corpus pipeline over ``documents``: the stages, in order, and ``run``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import bpe, mixing, ngram_join, suffix_dedup, toxicity
from hourglass.llm.common import table
from hourglass.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (operator 2)."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.screen(docs, toxicity.train(*toxicity.sample(docs, labels)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that of the smallest doc_id (operator 10)."""
    return ngram_join.keep_one(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated 400-byte strings, whole characters only (operator 1)."""
    kind = docs.schema["n_chars"].dataType
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast(kind))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their targets, shard by shard (operator 9)."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mixed documents (operator 7)."""
    return bpe.token_digest(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None  # the toxicity model cannot be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
