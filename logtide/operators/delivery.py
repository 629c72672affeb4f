"""Export of hour files by domain and day, and their reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import export_path
from .lookups import domain_semi_join


def export_plan(files: DataFrame, domains: DataFrame) -> DataFrame:
    """Source files of the listed domains with the path each is delivered under.

    ``path`` is ``<domain>/<yyyy>/<MM>/<dd>/<hour file>``; adds domain, day and target.
    """
    parts = F.split("path", "/")
    placed = files.select(
        "*",
        F.get(parts, F.lit(0)).alias("domain"),
        F.concat_ws("-", *[F.get(parts, F.lit(i)) for i in (1, 2, 3)]).alias("day"),
        export_path("path").alias("target"),
    )
    return domain_semi_join(placed, domains)


def reconcile_delivery(plan: DataFrame, delivered: DataFrame) -> DataFrame:
    """target, source_size, delivered_size (0 when absent), difference, status.

    Status is ``failed`` when nothing arrived, ``short`` when the sizes differ,
    else ``ok``. A file delivered several times counts with its largest size, so
    every planned file has one row.
    """
    arrived = delivered.groupBy(F.col("path").alias("target")).agg(F.max("size").alias("_arrived"))
    sizes = plan.select("target", F.col("size").alias("source_size")).join(arrived, "target", "left")
    both = sizes.select(
        "target", "source_size", F.coalesce("_arrived", F.lit(0)).cast("bigint").alias("delivered_size")
    )
    difference = F.col("source_size") - F.col("delivered_size")
    status = (
        F.when(F.col("delivered_size") == 0, "failed").when(difference != 0, "short").otherwise("ok")
    )
    return both.withColumns({"difference": difference, "status": status})


def delivery_failures(reconciled: DataFrame) -> DataFrame:
    """The files to send again."""
    return reconciled.where(F.col("status") == "failed")
