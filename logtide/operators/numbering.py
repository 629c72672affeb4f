"""Row numbering, ranking, sorting and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through
from .lookups import lookup_join

# Largest k for which Spark plans a group limit (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
SLICES = 64


def dense_index(
    df: DataFrame, order_by: Sequence[Column | str], index: str = "idx", start: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Contiguous numbers in the order of ``order_by``, without sorting in one task.

    Rows are range-partitioned, sorted and written as a table; equal values of the order are dealt
    to several partitions by a hash of the row. A row's number is its position in its
    file plus the rows of all earlier files, so a reader reads the columns it needs, and
    a lost executor takes nothing with it. ``partitions`` sets the number of sorts for large
    inputs (default: the session's shuffle width). The sampling for the ranges reads the input
    once more: write a costly one through first.
    """
    spread = F.xxhash64(*[c for c, t in df.dtypes if "map" not in t and "variant" not in t])
    order = [*order_by, spread]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    written = write_through(ranged.sortWithinPartitions(*order), "numbered")
    placed = written.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # One row per file; names begin with the number of the partition, and their footers hold the counts.
    number = F.regexp_extract("_file", r"^part-(\d+)-", 1).cast("bigint")
    sizes = placed.groupBy("_file").agg(F.count("*").alias("_rows"))
    before = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_file")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_row") + F.lit(start)).alias(index))


def unique_id(df: DataFrame, index: str = "uid") -> DataFrame:
    """Unique numbers with gaps; no shuffle, no sort."""
    return df.withColumn(index, F.monotonically_increasing_id())


def rank_per_user(
    scores: DataFrame, user: str = "user", item: str = "item", score: str = "score", rank: str = "rank"
) -> DataFrame:
    """Every item ranked from 1 within its user, best score first, ties by item.

    A user's items may span many partitions: rows are numbered over the whole
    (user, score, item) order and each user's first number is taken off. The first
    numbers are written as a table, so that the join is between two plain scans: a
    broadcast where they are few, else a shuffle that slices a hot user's partition.
    """
    numbered = dense_index(scores, [F.col(user), F.col(score).desc(), F.col(item)], "_n")
    firsts = write_through(numbered.groupBy(user).agg(F.min("_n").alias("_first")), "first-numbers")
    ranked = lookup_join(numbered, firsts, [user], "inner")
    return ranked.select(*scores.columns, (F.col("_n") - F.col("_first") + 1).alias(rank))


def global_sort(df: DataFrame, *order_by: Column | str) -> DataFrame:
    """Total order across partitions, by range partitioning."""
    return df.orderBy(*order_by)


def take_n(df: DataFrame, n: int, *order_by: Column | str) -> DataFrame:
    """The first n rows in the given order, so that a second run takes the same."""
    return df.orderBy(*order_by).limit(n)


def top_k(df: DataFrame, k: int, *order_by: Column | str) -> DataFrame:
    """The k first rows by the caller's ordering: a heap per task, then one merge of k rows each."""
    return df.orderBy(*order_by).limit(k)


def top_k_per_key(
    df: DataFrame, k: int, keys: Sequence[str], order_by: Sequence[Column | str], rank: str = "rank"
) -> DataFrame:
    """The k first rows of every key, ranked from 1.

    Up to GROUP_LIMIT the planner pushes the rank filter below the shuffle, so each task
    sends at most k rows per key. Beyond it a key is first ranked in SLICES slices, and
    only the k first rows of each slice meet in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    if k <= GROUP_LIMIT:
        # The planner itself puts a group limit before and after the shuffle.
        return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
    # By the row's place as well: equal rows of a key are dealt to all slices.
    spread = df.withColumn("_slice", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SLICES)))
    sliced = Window.partitionBy(*keys, "_slice").orderBy(*order_by)
    best = spread.withColumn(rank, F.row_number().over(sliced)).where(F.col(rank) <= k).drop("_slice", rank)
    return best.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
