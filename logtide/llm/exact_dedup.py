"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one row
per digest before it meets the index in a sort-merge anti-join; what is new is
appended. Everything is built-in Spark expressions.

Defined results: a null text counts as empty, texts of space characters only are
equal to it; of a group of equal texts one row is kept, also where rows have equal
ids and texts; a null id sorts after all ids; an empty table gives no rows. Only
``doc_id`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_folder, remove_at_exit, write_through
from .common import SPACE, least_row, text_or_empty

ROWS_PER_BUCKET = 1 << 20  # a new index gets so many buckets that one holds about this many rows of its first batch
LEAST_BUCKETS = 16


def digest() -> Column:
    """SHA-256 of the text without space characters."""
    return F.sha2(F.regexp_replace(text_or_empty(), SPACE + "+", "").cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256 of the text without space characters, n_points of the original text, a number of the row."""
    points = F.char_length(text_or_empty()).cast("long")
    return docs.select("doc_id", digest().alias("text_sha256"), points.alias("n_points"), F.monotonically_increasing_id().alias("nth"))


def best_of_digest(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays and the group's size. Combined before the shuffle."""
    # The smallest of (fewer points last, nulls last, id, first row) is the row that stays.
    best = F.min(F.struct(-F.col("n_points"), F.col("doc_id").isNull(), "doc_id", "nth"))
    return rows.groupBy("text_sha256").agg(
        best.getField("doc_id").alias("keep_id"), best.getField("nth").alias("keep_nth"), F.count(F.lit(1)).alias("group_size"))


class DigestIndex:
    """Digests seen so far, as a table bucketed and sorted by digest.

    ``name`` is a catalog table. Files lie in ``path`` where given, else in the warehouse. Runs of one
    name must not overlap. The number of buckets is set when the table is created, and read from the catalog later.
    """

    def __init__(self, spark, name: str, path: str | None = None, buckets: int | None = None):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _append(self, groups: DataFrame, buckets: int) -> None:
        writer = groups.repartition(buckets, "text_sha256").write.mode("append").format("parquet").bucketBy(buckets, "text_sha256").sortBy("text_sha256")
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)

    def create(self, groups: DataFrame) -> None:
        """Make the table, without rows, unless it is there; ``groups`` tells its columns and how many buckets it needs."""
        if not self.exists():
            self.buckets = self.buckets or max(LEAST_BUCKETS, -(-groups.count() // ROWS_PER_BUCKET))
            self._append(groups.limit(0).select("text_sha256", "keep_id", "group_size"), self.buckets)
        for row in self.spark.sql(f"DESCRIBE EXTENDED {self.name}").filter("col_name = 'Num Buckets'").collect():
            self.buckets = int(row.data_type)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest the index lacks: a sort-merge anti-join on the index's own buckets."""
        return groups.join(self.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add groups that are not in the index."""
        self._append(groups.select("text_sha256", "keep_id", "group_size"), self.buckets)

    def drop(self) -> None:
        """Take the table out of the catalog; files under ``path`` stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def decided(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Add the batch to the index; doc_id, keep_id, group_size, kept, text_sha256, n_points of every row."""
    rows = write_through(digests(docs), "digests")
    groups = write_through(best_of_digest(rows), "digests")
    index.create(groups)
    # What the index lacks is written aside before the append, so a task that runs again finds the index as it was.
    fresh = write_through(index.unseen(groups), "digests")
    known = index.read().select("text_sha256", F.col("keep_id").alias("known_id"))
    seen = groups.join(known.hint("merge"), "text_sha256").select(
        "text_sha256", F.col("known_id").alias("keep_id"), F.lit(None).cast("long").alias("keep_nth"), "group_size")
    verdicts = write_through(fresh.unionByName(seen), "digests")
    index.append(fresh)
    # A shuffle on both sides: adaptive execution slices the partition of a digest that a third of the rows share.
    return rows.join(verdicts, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("nth") == F.col("keep_nth"), F.lit(False)).alias("kept"), "text_sha256", "n_points")


def exact_dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Add the batch to the index; return one row per document with the row that stays.

    Columns: doc_id, keep_id, group_size (rows of the batch with this text), kept,
    text_sha256. Of equal texts the row with the most code points, then the smallest
    id stays; a text already in the index keeps the id stored there, and no row of the
    batch is kept.
    """
    return decided(docs, index).drop("n_points")


def kept_documents(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, with the columns they came with; of rows equal in id, digest and code points the smallest."""
    # One key of digest, length and id, so that the join's shuffle also serves the grouping after it.
    key = lambda digest, points: F.concat_ws(":", digest, points, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    wanted = decided(docs, index).filter("kept").select(key(F.col("text_sha256"), F.col("n_points")).alias("_key"))
    rows = docs.select(F.struct("*").alias("_row"), key(digest(), F.char_length(text_or_empty())).alias("_key"))
    return least_row(rows.join(write_through(wanted, "kept"), "_key").select("_key", "_row")).select("_row.*")


@contextmanager
def scratch_index(spark) -> Iterator[DigestIndex]:
    """An empty index for one batch alone; its table goes at the end, its files when the driver ends."""
    index = new_index(spark)
    remove_at_exit(spark, index.path)
    try:
        yield index
    finally:
        index.drop()


def new_index(spark, label: str = "digest_index") -> DigestIndex:
    """An empty index in the shared folder, under a name of its own."""
    folder = new_folder(spark, label)
    return DigestIndex(spark, folder.rsplit("/", 1)[1].replace("-", "_"), folder)
