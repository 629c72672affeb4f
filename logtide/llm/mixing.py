"""Mix sources to target weights by a low-discrepancy schedule.

Each source's words are shuffled and cut into blocks of equal size. The schedule is a van
der Corput sequence: point number p, its bits in reverse, is a slot of the mix, and each
source owns as many neighbouring points as its target has blocks, so its slots lie evenly
among all others. The r-th slot of a source takes its block r modulo the number of blocks:
a source is gone through whole before any of it repeats. Everything is built-in Spark
expressions.

Defined results: a null text has size 0 and is never taken; the null source is a source of
its own, after all others; repeated rows are separate rows; an empty table gives no rows; if
all sizes are 0, all targets are 0. Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import write_through
from .common import WORD, text_or_empty

WEIGHTS = (1, 2, 3)
MOST = 3  # times a source, and so each document, is taken at most
BLOCK_WORDS = 2048  # words of a block, but at most 1 / BLOCKS of its source
BLOCKS = 1024
STRETCH = 4096  # rows that one window numbers, about

_ALL = (W.unboundedPreceding, W.unboundedFollowing)
_BEFORE = (W.unboundedPreceding, -1)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and ``shuffled``, a hash of id and text that orders the source's documents."""
    text = text_or_empty()
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    return docs.select(
        "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(key.cast("binary")).alias("shuffled"),
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: nth (by code point, null last), weight, source_size, target.

    Targets share the sum of all sizes by weight, at most ``most`` times the source's size.
    Sources reach that bound in the order of bound per weight, so one pass in this order
    finds all that do. The windows run over one row per source.
    """
    cap = F.col("source_size") * most
    by_ratio = W.orderBy(F.col("source_size") / F.col("weight"), "nth")
    everything = W.orderBy("nth").rowsBetween(*_ALL)
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    first_open = F.col("place") == F.col("n_full") + 1
    return (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("nth", F.row_number().over(W.orderBy(F.col("source").isNull(), "source")))
        .withColumn("weight", F.element_at(cycle, (F.col("nth") - 1) % len(weights) + 1))
        # Words and weights left for this source and all after it, if all before it reach their bound.
        .withColumn("words", F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(*_BEFORE)), F.lit(0)))
        .withColumn("shares", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio.rowsBetween(*_BEFORE)), F.lit(0)))
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("full", F.col("words") * F.col("weight") >= cap * F.col("shares"))
        .withColumn("n_full", F.sum(F.col("full").cast("int")).over(everything))
        .withColumn("open_words", F.max(F.when(first_open, F.col("words"))).over(everything).cast("double"))
        .withColumn("open_shares", F.max(F.when(first_open, F.col("shares"))).over(everything).cast("double"))
        .select("source", "nth", "weight", "source_size",
                F.when(F.col("full"), cap.cast("double"))
                .otherwise(F.col("weight") * F.col("open_words") / F.col("open_shares")).alias("target"))
    )


def block_plan(targets: DataFrame, most: int = MOST) -> DataFrame:
    """Per source with words: block_words, blocks, and its points [low, high) of the ``points`` in all."""
    rest = F.col("target") - F.col("rounds") * F.col("source_size")
    return (
        targets.filter("source_size > 0")
        .withColumn("block_words", F.expr(f"greatest(1, least({BLOCK_WORDS}, source_size div {BLOCKS}))"))
        .withColumn("blocks", F.expr("(source_size + block_words - 1) div block_words"))
        .withColumn("rounds", F.floor(F.col("target") / F.col("source_size")))
        .withColumn("slots", F.least(F.col("rounds") * F.col("blocks") + F.floor(rest / F.col("block_words") + 0.5), F.col("blocks") * most))
        .withColumn("high", F.sum("slots").over(W.orderBy("nth")))
        .withColumn("low", F.col("high") - F.col("slots"))
        .withColumn("points", F.sum("slots").over(W.orderBy("nth").rowsBetween(*_ALL)))
        .select("source", "nth", "weight", "source_size", "target", "block_words", "blocks", "low", "high", "points")
    )


def numbered(rows: DataFrame, keys: list[str], part: str, order: list[str], name: str, amount: str | None = None) -> DataFrame:
    """Number the rows of a key from 0, or sum ``amount`` over the rows before, in order of ``part``, then ``order``.

    Sums per (key, part) are added up first and the windows over rows stay within a part,
    so a key may hold any share of the rows.
    """
    value = F.lit(1) if amount is None else F.col(amount)
    ahead = W.partitionBy(*keys).orderBy(part).rowsBetween(*_BEFORE)
    starts = rows.groupBy(*keys, part).agg(F.sum(value).alias("_n")).select(
        *keys, part, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    within = W.partitionBy(*keys, part).orderBy(*order).rowsBetween(*_BEFORE)
    return rows.join(starts, [*keys, part]).withColumn(
        name, F.col("_start") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_start")


def schedule(plan: DataFrame) -> DataFrame:
    """All slots: nth (of the source), slot (its turn in the mix), rank in the source, epoch, block.

    A source's points are unrolled in two steps, so no row makes more than STRETCH others
    before the next shuffle.
    """
    stretches = plan.filter("high > low").select(
        "nth", "blocks", "points", "high", F.explode(F.sequence("low", F.col("high") - 1, F.lit(STRETCH).cast("long"))).alias("first"))
    unrolled = stretches.repartition("nth", "first").select(
        "nth", "blocks", "points",
        F.explode(F.sequence("first", F.least(F.col("first") + STRETCH, F.col("high")) - 1)).alias("point"))
    slots = unrolled.select(
        "nth", "blocks",
        F.conv(F.reverse(F.lpad(F.bin("point"), F.char_length(F.bin("points")), F.lit("0"))), 2, 10).cast("long").alias("slot"))
    slots = slots.withColumn("part", F.expr(f"slot div {STRETCH}"))
    return numbered(slots, ["nth"], "part", ["slot"], "rank").select(
        "nth", "slot", "rank", F.expr("rank div blocks").alias("epoch"), (F.col("rank") % F.col("blocks")).alias("block"))


def shuffled_documents(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents with words, with the words that precede them in their source's shuffled order (``ahead``)."""
    parts = sizes.count() // STRETCH + 1
    spread = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long")
    placed = (
        sizes.filter("size > 0")
        .withColumn("part", F.shiftright(spread * parts, 32))
        .join(plan.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    )
    return numbered(placed, ["nth"], "part", ["shuffled", "doc_id"], "ahead", "size")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, source, shuffled.

    ``taken`` counts the document's words in all slots that hold them; ``copies`` is the
    number of slots that hold its first word, for mixes of whole documents.
    """
    sizes = write_through(sized(docs), "sizes")
    targets = write_through(source_targets(sizes, weights, most), "targets")
    plan = write_through(block_plan(targets, most), "plan")
    times = schedule(plan).groupBy("nth", "block").agg(F.count(F.lit(1)).alias("times"))
    first = F.expr("ahead div block_words")
    last = F.expr("(ahead + size - 1) div block_words")
    words = F.expr("least(ahead + size, (block + 1) * block_words) - greatest(ahead, block * block_words)")
    pieces = shuffled_documents(sizes, plan).withColumn("block", F.explode(F.sequence(first, last))).withColumn("words", words)
    row = ["nth", "ahead", "doc_id", "source", "shuffled", "size", "source_size", "target"]
    times_taken = F.coalesce("times", F.lit(0).cast("long"))
    taken = (
        pieces.join(times, ["nth", "block"], "left").groupBy(*row)
        .agg(F.sum(F.col("words") * times_taken).alias("taken"),
             F.sum(F.when(F.col("block") == first, times_taken).otherwise(0)).alias("copies"))
        .drop("nth", "ahead")
    )
    none = F.lit(0).cast("long")
    empty = sizes.filter("size = 0").join(
        targets.select(F.col("source").alias("_of"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_of")))
    return taken.unionByName(empty.drop("_of").withColumns({"taken": none, "copies": none}))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix as whole documents, each as often as its first word is taken; same columns as ``docs``.

    Rows of equal id, source and text are taken alike.
    """
    copies = mix(docs, weights, most).filter("copies > 0").groupBy("doc_id", "source", "shuffled").agg(F.max("copies").alias("copies"))
    copies = copies.select(F.col("doc_id").alias("_id"), F.col("source").alias("_of"), F.col("shuffled").alias("_key"), "copies")
    text = text_or_empty()
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text).cast("binary"))
    whole = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), key.alias("_key"))
    same = (whole["_key"] == copies["_key"]) & whole["_doc"].eqNullSafe(copies["_id"]) & whole["_source"].eqNullSafe(copies["_of"])
    found = whole.join(copies, same)
    return found.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
