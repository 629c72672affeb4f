"""A training corpus from raw documents: select, dedup exactly, dedup nearly, mix, pack.

Every stage takes (spark, docs, sf_dir) and returns documents with the columns they came
with; the last one returns the packed pieces. ``run`` writes each stage's rows as Parquet
in the shared folder and gives the reread table to the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logtide.llm import exact_dedup, jaccard_join, mixing, ordinal, packing
from logtide.llm.common import bounded_batches, table
from logtide.session import write_through


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the graded quality classifier selects; it learns from the rated ones among them."""
    bounded_batches(spark)
    ratings = ordinal.quality_ratings(table(spark, sf_dir, "labels"))
    return ordinal.select_documents(docs, ordinal.train(docs, ratings, grades=3))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, against an index that begins empty."""
    with exact_dedup.scratch_index(spark) as index:
        return exact_dedup.kept_documents(docs, index)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    bounded_batches(spark)
    return jaccard_join.one_of_each_group(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the schedule of the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document."""
    bounded_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixed), ("packing", packed),
]

# Token ids and fitted weights have no SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
