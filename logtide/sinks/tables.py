"""Dated indexes, hourly tables and the catalog."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.times import batch_time_parts

HOUR_PARTITION = ["month_", "day_", "hour_"]


def dated_index_sink(documents: DataFrame, root: str, index: str, suffix: Column | str) -> None:
    """Append documents under ``index_name=<index>/index_date=<suffix>``.

    The suffix is a value or an expression per row. There is no document id, so
    a second write of the same rows repeats them; streams use ``write_batch``.
    """
    date = F.lit(suffix) if isinstance(suffix, str) else suffix
    placed = documents.withColumns({"index_name": F.lit(index), "index_date": date})
    placed.hint("rebalance", "index_date").write.mode("append").partitionBy(
        "index_name", "index_date"
    ).parquet(root)


def hourly_parquet_append(df: DataFrame, path: str, moment: Column | str) -> None:
    """Append under ``month_=yyyyMM/day_=dd/hour_=HH`` of the given time (batch or event)."""
    parts = batch_time_parts(moment)
    placed = df.withColumns({name: parts[name] for name in HOUR_PARTITION})
    placed.hint("rebalance", *HOUR_PARTITION).write.mode("append").partitionBy(*HOUR_PARTITION).parquet(path)


def create_hourly_table(spark: SparkSession, table: str, path: str, columns: str, batches: bool = False) -> None:
    """Catalog table over the hourly layout; ``columns`` is the DDL of the data columns.

    ``batches`` adds the batch id below the hour, as ``write_hours`` lays it out.
    """
    own, key = (", batch_id BIGINT", ", batch_id") if batches else ("", "")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, month_ STRING, day_ STRING, hour_ STRING{own}) "
        f"USING parquet PARTITIONED BY (month_, day_, hour_{key}) LOCATION '{path}'"
    )


def register_partition(spark: SparkSession, table: str, month: str, day: str, hour: str) -> None:
    """Add one hour to the catalog; one that is already there is no error."""
    spark.sql(
        f"ALTER TABLE {table} ADD IF NOT EXISTS "
        f"PARTITION (month_='{month}', day_='{day}', hour_='{hour}')"
    )
    spark.catalog.refreshTable(table)


def register_all_partitions(spark: SparkSession, table: str) -> None:
    """Add every hour folder found on disk in one catalog call."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def write_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()
) -> None:
    """Write one micro-batch under its own id, replacing what an earlier try left there."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def write_hours(df: DataFrame, path: str, batch_id: int, table: str | None = None) -> None:
    """Write one micro-batch under ``month_/day_/hour_/batch_id``, and put its hours into the catalog.

    Only the folders of this batch id are replaced, so a batch that runs again leaves its
    rows once, and other batches of the hour stay. The hours are those seen while writing: the batch
    is computed once.
    """
    spark = df.sparkSession
    layout = [*HOUR_PARTITION, "batch_id"]
    seen = Observation(f"hours-{batch_id}-{uuid.uuid4().hex}")
    # The hours that a batch touches are a handful of short values.
    placed = df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).observe(
        seen, F.collect_set(F.to_json(F.struct(*HOUR_PARTITION))).alias("hours"))
    placed.hint("rebalance", *HOUR_PARTITION).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*layout).parquet(path)
    if table is None:
        return
    hours = [json.loads(hour) for hour in sorted(seen.get["hours"])]
    for hour in hours:
        values = ", ".join(f"{name}='{hour[name]}'" for name in HOUR_PARTITION)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({values}, batch_id={batch_id})")
    if hours:
        spark.catalog.refreshTable(table)


def read_sums(spark: SparkSession, path: str, keys: Sequence[str], value: str) -> DataFrame:
    """Partial sums written by ``write_batch`` -> one row per key: the sum over all batches.

    Other columns come from the newest batch that has the key.
    """
    rows = spark.read.parquet(path)
    others = [name for name in rows.columns if name not in (*keys, value, "batch_id")]
    newest = [F.max_by(name, "batch_id").alias(name) for name in others]
    return rows.groupBy(*keys).agg(F.sum(value).alias(value), *newest)


def compact_sums(spark: SparkSession, path: str, target: str, keys: Sequence[str], value: str, day: Column) -> None:
    """Fold all batches into one table by day, for readers of long histories.

    ``day`` is an expression over the keys. The answer of ``read_sums`` is kept, one row per key.
    """
    folded = read_sums(spark, path, keys, value).withColumns({"day": day, "batch_id": F.lit(0)})
    folded.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(target)


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Batches written by ``write_batch`` -> the newest row of every key."""
    rows = spark.read.parquet(path)
    values = [name for name in rows.columns if name not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{name}").alias(name) for name in values])
