"""Batch readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_trimmed, strict_long


def text_scan(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per line (``value``) of files, folders or globs; gzip is recognised by name."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths))


def numeric_matrix_scan(spark: SparkSession, paths: str | Sequence[str], strict: bool = False) -> DataFrame:
    """Blank-separated whole numbers -> ``cells`` array<bigint> per line.

    A line with anything else is dropped, or fails the job with ``strict``.
    """
    lines = text_scan(spark, paths)
    rows = lines.select("value", F.transform(split_trimmed("value", " "), strict_long).alias("cells"))
    bad = F.exists("cells", lambda cell: cell.isNull())
    if not strict:
        return rows.where(~bad).select("cells")
    error = F.raise_error(F.concat(F.lit("malformed row: "), "value"))
    return rows.select(F.when(bad, error.cast("array<bigint>")).otherwise(F.col("cells")).alias("cells"))


# Channel dimension, column name -> position.
CHANNEL_FIELDS = {"domain": 0, "customer": 6, "business": 10}


def dimension_csv_scan(
    spark: SparkSession, paths: str | Sequence[str], fields: dict[str, int] | None = None
) -> DataFrame:
    """Named columns of a (gzip) CSV dimension without header; all text.

    The schema is stated up to the last wanted column, so nothing is inferred
    and only the wanted columns are converted.
    """
    wanted = fields or CHANNEL_FIELDS
    width = max(wanted.values()) + 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    rows = spark.read.schema(schema).csv(paths if isinstance(paths, str) else list(paths))
    return rows.select(*[F.col(f"c{at}").alias(name) for name, at in wanted.items()])


def index_range_scan(
    spark: SparkSession, root: str, index: str, suffix: str, start: str, stop: str,
    time: str = "timestamp", schema: str | None = None,
) -> DataFrame:
    """One dated index, between two times inclusive (text seconds of equal length).

    The one folder of that index and date is opened, so no other is listed and the date
    stays the text it is; the time range goes to the Parquet reader. A stated ``schema``
    saves opening a file to learn it.
    """
    folder = f"{root.rstrip('/')}/index_name={index}/index_date={suffix}"
    rows = spark.read.parquet(folder) if schema is None else spark.read.schema(schema).parquet(folder)
    return rows.where(F.col(time).between(start, stop))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """path and length of every file below a folder, names from the root on; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", "length")
    )
    # The root as the file system writes it; every file's path begins with it.
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    base = path.makeQualified(store.getUri(), store.getWorkingDirectory()).toString().rstrip("/")
    # Spark writes local paths with an empty authority (file:///), Hadoop without (file:/).
    plain = F.regexp_replace("path", "^file:/+", "file:/")
    return files.select(F.substring(plain, len(base) + 2, 1 << 30).alias("path"), "length")
