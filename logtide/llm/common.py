"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The space characters of all operators: U+0020 and U+0009..U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = 16 << 20

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, folder)`` as query ``name``, with its answer in DuckDB SQL where SQL can say it."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            bounded_batches(spark)
            return fn(spark, folder)

        _queries[name] = run
        if oracle is not None:
            _oracles[name] = oracle
        return fn

    return wrap


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of one Arrow batch, so that long texts do not add up in a Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case. Texts of ASCII only take the faster function, which does the same there."""
    ascii_only = F.char_length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def row_key() -> Column:
    """What rows equal in ``doc_id`` and ``text`` have in common: a digest of the text, and the id."""
    return F.concat_ws(":", F.sha2(text_or_empty().cast("binary"), 256), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def least_row(rows: DataFrame) -> DataFrame:
    """_row: of rows (_key, _row) with one key the smallest, or that of the smallest text where rows have no order."""
    kind = dict(rows.dtypes)["_row"]
    least = F.min_by("_row", F.to_json("_row")) if "map<" in kind or "variant" in kind else F.min("_row")
    return rows.groupBy("_key").agg(least.alias("_row")).select("_row")


def crc_remainder(column: str, parts: int) -> Column:
    """crc32 of the value as text, modulo ``parts``; a null counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts
