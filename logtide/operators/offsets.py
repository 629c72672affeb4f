"""Stream positions as tables: ranges, bounds, ledgers and what batches read.

Messages are rows of (topic, partition_id, msg_offset, value); ranges are
(topic, partition_id, start_offset, end_offset) with the end excluded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strict_int, strict_long
from .lookups import lookup_join
from .rollups import batch_counts

PARTITION = ["topic", "partition_id"]


def explode_requests(manifest: DataFrame, messages: DataFrame) -> DataFrame:
    """Each range row becomes the messages it covers; overlapping ranges repeat them."""
    covered = (F.col("msg_offset") >= F.col("start_offset")) & (F.col("msg_offset") < F.col("end_offset"))
    return lookup_join(messages, manifest, PARTITION, "inner", covered)


def offset_range_fetch(messages: DataFrame, manifest: DataFrame) -> DataFrame:
    """Bounded read: the messages of all ranges, without the range columns."""
    return explode_requests(manifest, messages).select(*messages.columns)


def resume_from(messages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Messages at or after each partition's stored offset.

    A partition without a stored offset starts at its end, so none of its
    present messages appear.
    """
    at_or_after = F.col("msg_offset") >= F.col("start_offset")
    return lookup_join(messages, ledger, PARTITION, "inner", at_or_after).select(*messages.columns)


def check_offset_bounds(manifest: DataFrame, messages: DataFrame) -> DataFrame:
    """Ranges that reach outside what the log still holds, with the bounds they break."""
    bounds = batch_counts(messages).select(
        *PARTITION, F.col("from_offset").alias("low"), F.col("until_offset").alias("high")
    )
    held = (F.col("low") <= F.col("start_offset")) & (F.col("end_offset") <= F.col("high"))
    return manifest.join(bounds, PARTITION, "left").where(~F.coalesce(held, F.lit(False)))


def missing_partitions(requested: DataFrame, found: DataFrame) -> DataFrame:
    """Requested topic partitions of which nothing is known."""
    known = found.select(*PARTITION).distinct()
    return requested.select(*PARTITION).distinct().join(known, PARTITION, "left_anti")


def save_offset_ledger(messages: DataFrame) -> DataFrame:
    """Per topic, ``partition:offset,...`` of the first offset of each partition in the batch.

    Storing the start means a restart reads the last batch again.
    """
    starts = batch_counts(messages)
    entries = F.array_sort(F.collect_list(F.struct("partition_id", "from_offset")))
    # One entry per partition of the topic: the list is as short as the topic is wide.
    pairs = F.transform(entries, lambda e: F.concat_ws(":", e.partition_id, e.from_offset))
    return starts.groupBy("topic").agg(F.array_join(pairs, ",").alias("ledger"))


def save_offset_nodes(messages: DataFrame) -> DataFrame:
    """The other encoding: one stored offset per topic and partition."""
    return batch_counts(messages).select(*PARTITION, F.col("from_offset").alias("start_offset"))


def load_offset_ledger(ledger: DataFrame) -> DataFrame:
    """``partition:offset,...`` per topic -> topic, partition_id, start_offset."""
    entry = F.split(F.col("_entry"), ":")
    return ledger.select("topic", F.explode(F.split("ledger", ",")).alias("_entry")).select(
        "topic",
        strict_int(F.get(entry, F.lit(0))).alias("partition_id"),
        strict_long(F.get(entry, F.lit(1))).alias("start_offset"),
    )


def starting_offsets_json(offsets: DataFrame) -> DataFrame:
    """Stored offsets -> one row with the ``startingOffsets`` JSON of the Kafka source.

    An empty table gives ``latest``.
    """
    partitions = F.array_sort(F.collect_list(F.struct(F.col("partition_id").cast("string"), "start_offset")))
    per_topic = offsets.groupBy("topic").agg(F.map_from_entries(partitions).alias("_p"))
    topics = F.array_sort(F.collect_list(F.struct("topic", F.to_json("_p").alias("json"))))
    # The inner maps differ in their keys by topic, so the outer level is joined as text.
    fields = F.transform(topics, lambda t: F.concat(F.lit('"'), t.topic, F.lit('":'), t.json))
    text = F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))
    return per_topic.agg(F.when(F.count("*") > 0, text).otherwise(F.lit("latest")).alias("starting_offsets"))


def batch_ranges(messages: DataFrame) -> DataFrame:
    """batch_id, topic, partition, start_offset, end_offset (exclusive), messages: what each batch of a stream read.

    ``messages`` are stored batches with their ``batch_id``; how much a batch takes is the source's own
    limit (``maxFilesPerTrigger``, ``maxBytesPerTrigger`` or ``maxOffsetsPerTrigger``).
    """
    return messages.groupBy("batch_id", *PARTITION).agg(
        F.min("msg_offset").alias("start_offset"), (F.max("msg_offset") + 1).alias("end_offset"), F.count("*").alias("messages"))
