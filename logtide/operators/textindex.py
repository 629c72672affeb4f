"""A stored inverted index over named documents, and the best documents for a query from it.

``root`` holds three Parquet tables, each with one folder per appended batch:

- ``names`` (name): what has been indexed;
- ``postings`` (term, block, docs, max_tf, entries of name and tf), by bucket of the term and sorted
  by term and block. A block is a set of documents of its batch, about ``block_docs`` of them, so a word
  that a third of all documents hold is still many rows of bounded size;
- ``batches`` (docs, buckets): written last, so a batch that broke off is not seen, and appending it again
  replaces it.

Only words and counts are stored: document frequencies and weights are taken from the counts of all
batches when a query comes, so the index needs no rewriting as it grows. Rows of one name in one batch are one
document; a name that an earlier batch has indexed is passed over, and so are null names. Null and empty
word lists hold no word but count as documents. A null term of a query finds nothing but counts as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_through
from .lookups import lookup_join
from .textsim import counts_with_totals, document_lengths

BUCKETS = 64
BLOCK_DOCS = 4096

# Blocks that are scored before others are ruled out.
FIRST_BLOCKS = 8

# Scores are ranked by nine decimals, then by name.
DIGITS = 9

TABLES = {
    "names": "name string, batch bigint",
    "postings": "term string, block bigint, docs bigint, max_tf double, "
    "entries array<struct<name: string, tf: double>>, batch bigint, bucket int",
    "batches": "docs bigint, buckets int, batch bigint",
}


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def create_index(spark: SparkSession, root: str) -> None:
    """An empty index in a new folder."""
    for table, schema in TABLES.items():
        spark.createDataFrame([], schema).write.partitionBy("batch").parquet(f"{root}/{table}")


def _committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of the batches that were written to their end."""
    rows = spark.read.schema(TABLES[table]).parquet(f"{root}/{table}")
    if table == "batches":
        return rows
    return lookup_join(rows, _committed(spark, root, "batches").select("batch"), ["batch"], "left_semi")


def append_documents(
    docs: DataFrame, root: str, batch: int, buckets: int = BUCKETS, block_docs: int = BLOCK_DOCS
) -> None:
    """Index the new names among (name, words) as batch number ``batch``.

    The first batch sets the number of buckets for all. Texts are shuffled by name and counted, then
    postings are gathered by (term, block): one shuffle of (name, term) rows and the sorted write.
    """
    spark = docs.sparkSession
    settled = _committed(spark, root, "batches").agg(F.max("buckets")).first()[0]
    buckets = settled or buckets
    known = _committed(spark, root, "names").where(F.col("batch") != batch).select("name")
    fresh = lookup_join(docs.where(F.col("name").isNotNull()).select("name", "words"), known, ["name"], "left_anti")
    fresh = write_through(fresh, "fresh-documents")
    lengths = write_through(document_lengths(fresh), "lengths")
    total = lengths.count()
    blocks = max(1, -(-total // block_docs))
    counted = counts_with_totals(fresh).where(F.col("term").isNotNull())
    tf = F.sqrt(F.col("cnt") / F.col("total"))
    placed = counted.select("term", "name", tf.alias("tf"), F.pmod(F.xxhash64("name"), F.lit(blocks)).alias("block"))
    postings = placed.groupBy("term", "block").agg(
        F.count("*").alias("docs"), F.max("tf").alias("max_tf"), F.collect_list(F.struct("name", "tf")).alias("entries"))
    postings = postings.withColumn("bucket", _bucket(F.col("term"), buckets))
    ordered = ["bucket", "term", "block"]
    sorted_rows = postings.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    sorted_rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/postings/batch={batch}")
    lengths.select("name").write.mode("overwrite").parquet(f"{root}/names/batch={batch}")
    done = spark.createDataFrame([(total, buckets)], "docs bigint, buckets int")
    done.coalesce(1).write.mode("overwrite").parquet(f"{root}/batches/batch={batch}")


def _scores(postings: DataFrame, weights: DataFrame, norm: float, size: int) -> DataFrame:
    hits = lookup_join(postings.select("term", F.inline("entries")), weights, ["term"], "inner")
    sums = hits.groupBy("name").agg(
        F.count("*").alias("matched"), F.sum(F.col("tf") * F.col("idf") * F.col("idf")).alias("_sum"))
    score = F.coalesce(F.try_divide(F.col("_sum"), F.lit(norm)), F.lit(0.0)) * F.col("matched") / size
    return sums.select("name", "matched", score.alias("score"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    return scores.orderBy(F.round("score", DIGITS).desc(), "name").limit(k)


def search(spark: SparkSession, root: str, query: DataFrame, k: int, scored: list | None = None) -> DataFrame:
    """name, matched, score: the k best documents for a query (one row per ``term``).

    Scores are those of ``textsim.score_documents``; equal ones (to nine decimals) go by name. Documents without
    a query term are not listed, so there may be fewer than k. Only the buckets of the query's terms are read. From
    the block maxima each block of documents has a highest possible score; FIRST_BLOCKS of the highest are scored,
    and of the others those that may still reach the k-th score. The answer is exact. ``scored`` receives
    the numbers of blocks that were scored, and of all that hold a term.
    """
    batches = _committed(spark, root, "batches").agg(F.sum("docs"), F.max("buckets")).first()
    documents, buckets = batches[0] or 0, batches[1] or BUCKETS
    wanted = write_through(query.select("term").distinct(), "query")
    size = wanted.count()
    bucket = _bucket(F.col("term"), buckets)
    touched = [r[0] for r in wanted.select(bucket.alias("bucket")).distinct().collect()]  # at most `buckets` numbers
    postings = _committed(spark, root, "postings").where(F.col("bucket").isin(touched))
    postings = lookup_join(postings, wanted, ["term"], "left_semi")
    maxima = write_through(postings.select("batch", "block", "term", "docs", "max_tf"), "block-maxima")
    idf = F.lit(1.0) + F.ln(F.lit(documents) / F.sum("docs"))
    weights = write_through(maxima.groupBy("term").agg(idf.alias("idf")), "query-weights")
    norm = weights.agg(F.sqrt(F.sum(F.col("idf") * F.col("idf")))).first()[0] or 0.0
    highest = F.sum(F.col("max_tf") * F.col("idf") * F.col("idf")) / F.lit(norm or 1.0) * F.count("*") / F.lit(max(size, 1))
    bounds = lookup_join(maxima, weights, ["term"], "inner").groupBy("batch", "block").agg(highest.alias("_highest"))
    bounds = write_through(bounds, "block-bounds")

    place = ["batch", "block"]
    first = write_through(bounds.orderBy(F.col("_highest").desc(), *place).limit(FIRST_BLOCKS), "first-blocks")
    found = _scores(lookup_join(postings, first.select(*place), place, "left_semi"), weights, norm, max(size, 1))
    best = write_through(_best(found, k), "best-documents")
    kth = best.agg(F.count("*"), F.min("score")).first()
    # Half a unit of the last decimal on each side of the rounding.
    reach = F.lit(True) if kth[0] < k else F.col("_highest") >= kth[1] - 10.0 ** -DIGITS
    others = write_through(lookup_join(bounds.where(reach), first.select(*place), place, "left_anti"), "other-blocks")
    if scored is not None:
        scored += [first.count() + others.count(), bounds.count()]
    more = _scores(lookup_join(postings, others.select(*place), place, "left_semi"), weights, norm, max(size, 1))
    return _best(best.unionByName(more), k)
