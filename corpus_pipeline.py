"""The corpus pipeline: quality classifier, near-duplicates, decontamination, mixing, token-ID output.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; stages meet as Parquet tables in the
folder that all executors share. SQL cannot express the stages, so tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catloom.llm import decontaminate, factorisation, mixing, near_copies, token_ids
from catloom.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts."""
    return factorisation.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are 0.8 or more alike: the one with the smallest id."""
    return near_copies.drop_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row's ids lie in the token-ID shards, and their checksum, read back through the index."""
    return token_ids.token_ids(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mix", mix), ("tokens", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
