"""Actual ratings against predicted ones."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_folder, remove_folder


def rating_prediction_join(ratings: DataFrame, predictions: DataFrame) -> DataFrame:
    """Inner join on (user, item) -> user, item, rate, pred, pairs.

    Repeated (user, item) pairs on both sides multiply. Equal rows are folded
    before the join and their number is carried in ``pairs``, so a pair rated
    and predicted n times makes one row with ``pairs`` = n * n, not n * n rows.
    """
    rated = ratings.groupBy("user", "item", "rate").agg(F.count("*").alias("_rated"))
    predicted = predictions.groupBy("user", "item", "pred").agg(F.count("*").alias("_predicted"))
    return rated.join(predicted, ["user", "item"]).select(
        "user", "item", "rate", "pred", (F.col("_rated") * F.col("_predicted")).alias("pairs")
    )


def rated_predictions(ratings: DataFrame, predictions: DataFrame) -> DataFrame:
    """The join itself, for export: user, item, rate, pred once per multiplied pair."""
    return ratings.select("user", "item", "rate").join(predictions.select("user", "item", "pred"), ["user", "item"])


def prediction_error(ratings: DataFrame, predictions: DataFrame) -> DataFrame:
    """pairs, mse: mean squared error over the multiplied pairs of :func:`rated_predictions`.

    Each side is summed per (user, item) before the join: with n, the sum and the sum of
    squares of both, the squared differences of all pairs add up to
    m * sum(r^2) - 2 * sum(r) * sum(p) + n * sum(p^2). One shuffle per side.
    """
    def sums(df: DataFrame, value: str, prefix: str) -> DataFrame:
        x = F.col(value)
        return df.where(x.isNotNull()).groupBy("user", "item").agg(
            F.count("*").alias(f"{prefix}n"), F.sum(x).alias(f"{prefix}1"), F.sum(x * x).alias(f"{prefix}2"))

    both = sums(ratings, "rate", "_r").join(sums(predictions, "pred", "_p"), ["user", "item"])
    squares = F.col("_pn") * F.col("_r2") - 2 * F.col("_r1") * F.col("_p1") + F.col("_rn") * F.col("_p2")
    pairs = F.sum(F.col("_rn") * F.col("_pn"))
    return both.agg(F.coalesce(pairs, F.lit(0)).alias("pairs"), F.try_divide(F.sum(squares), pairs).alias("mse"))


def store_pairs(df: DataFrame, value: str, table: str, folder: str, buckets: int) -> DataFrame:
    """Write (user, item, value) as a catalog table bucketed and sorted by (user, item) -> that table.

    Equal rows are folded before the shuffle to one with their number in ``rows``, so a pair
    that holds a third of all rows costs its bucket one row per value. Each bucket is one file, so two tables with
    as many buckets join on (user, item) where they lie, without an exchange.
    """
    folded = df.groupBy("user", "item", value).agg(F.count("*").alias("rows"))
    placed = folded.repartition(buckets, "user", "item")
    placed.write.bucketBy(buckets, "user", "item").sortBy("user", "item").option("path", folder).saveAsTable(table)
    return df.sparkSession.table(table)


@contextmanager
def scratch_pairs(df: DataFrame, value: str, buckets: int) -> Iterator[DataFrame]:
    """A stored table for the length of a block; table and folder are removed at its end."""
    spark = df.sparkSession
    folder = new_folder(spark, "pairs")
    table = "pairs_" + folder.rsplit("-", 1)[-1]
    try:
        yield store_pairs(df, value, table, folder, buckets)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_folder(spark, folder)


def stored_join(rated: DataFrame, predicted: DataFrame) -> DataFrame:
    """:func:`rating_prediction_join` of two stored tables: no row moves between tasks."""
    theirs = predicted.withColumnRenamed("rows", "_predicted")
    return rated.join(theirs, ["user", "item"]).select(
        "user", "item", "rate", "pred", (F.col("rows") * F.col("_predicted")).alias("pairs"))


def stored_error(rated: DataFrame, predicted: DataFrame) -> DataFrame:
    """:func:`prediction_error` of two stored tables; one row per task is sent on."""
    both = stored_join(rated, predicted).where(F.col("rate").isNotNull() & F.col("pred").isNotNull())
    gap = F.col("rate") - F.col("pred")
    pairs = F.sum("pairs")
    return both.agg(F.coalesce(pairs, F.lit(0)).alias("pairs"), F.try_divide(F.sum(gap * gap * F.col("pairs")), pairs).alias("mse"))


def stored_rows(rated: DataFrame, predicted: DataFrame) -> DataFrame:
    """:func:`rated_predictions` of two stored tables, multiplied rows and all."""
    joined = stored_join(rated, predicted)
    return joined.select("user", "item", "rate", "pred", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("pairs"))).alias("_n")).drop("_n")
