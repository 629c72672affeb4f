"""Stream readers: Kafka where its connector is present, file folders otherwise."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.setops import union_streams


def starting_position(reset: str | None) -> str:
    """``smallest`` starts at the earliest offset, anything else at the latest."""
    return "earliest" if (reset or "").lower() == "smallest" else "latest"


def kafka_options(
    servers: str,
    topics: Sequence[str],
    starting: str,
    max_rate: int = 0,
    batch_seconds: float = 0,
    partitions: int | None = None,
) -> dict[str, str]:
    """Source options; a rate per partition and second becomes a limit per trigger.

    Offsets JSON names its partitions, and exactly these are read (``assign``); with
    ``earliest`` or ``latest`` all partitions of the topics are. The source limits all
    partitions together, so a rate needs their number: it is taken from the JSON, or
    must be given.
    """
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting, "failOnDataLoss": "true"}
    if starting.startswith("{"):
        assigned = assigned_partitions(starting)
        options["assign"] = json.dumps(assigned)
        partitions = sum(map(len, assigned.values()))
    else:
        options["subscribe"] = ",".join(topics)
    if max_rate > 0 and batch_seconds > 0:
        if not partitions:
            raise ValueError("a rate per partition needs the number of partitions")
        options["maxOffsetsPerTrigger"] = str(int(max_rate * batch_seconds) * partitions)
    return options


def assigned_partitions(offsets: str) -> dict[str, list[int]]:
    """Offsets JSON -> the partitions it names per topic, as the ``assign`` option wants them."""
    return {topic: sorted(map(int, held)) for topic, held in json.loads(offsets).items()}


def _messages(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        F.col("partition").alias("partition_id"),
        F.col("offset").alias("msg_offset"),
        "timestamp",
    )


def stream_scan(
    spark: SparkSession, servers: str, topics: Sequence[str], reset: str | None = None, **limits: float
) -> DataFrame:
    """Subscribe to topics from the position the policy names."""
    options = kafka_options(servers, topics, starting_position(reset), **limits)
    return _messages(spark.readStream.format("kafka").options(**options).load())


def stream_resume_scan(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    starting_offsets: str,
    handler: Callable[[DataFrame], DataFrame] | None = None,
    **limits: float,
) -> DataFrame:
    """Subscribe from explicit offsets (inclusive), see ``starting_offsets_json``.

    They count on the first start only; afterwards the checkpoint holds the position.
    """
    options = kafka_options(servers, topics, starting_offsets, **limits)
    rows = _messages(spark.readStream.format("kafka").options(**options).load())
    return message_handler(rows, handler) if handler else rows


def offset_range_read(
    spark: SparkSession, servers: str, topics: Sequence[str], starting: str, ending: str
) -> DataFrame:
    """Bounded batch read of ``[starting, ending)``, both offsets JSON over the same partitions."""
    if assigned_partitions(starting) != assigned_partitions(ending):
        raise ValueError("the starting and ending offsets name different partitions")
    options = kafka_options(servers, topics, starting)
    return _messages(spark.read.format("kafka").options(**options).option("endingOffsets", ending).load())


def file_stream_scan(
    spark: SparkSession, path: str, schema, format: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """A growing folder as a stream; ``max_files`` bounds one batch's intake."""
    reader = spark.readStream.schema(schema).format(format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def table_stream_scan(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """The Parquet table ``<folder>/<name>.parquet`` as a stream, be it a file or a folder."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # A pattern, because a stream over a plain path must be a folder.
    return file_stream_scan(spark, f"{folder}/{name}.parque[t]", schema, max_files=max_files)


def multi_topic_scan(sources: dict[str, DataFrame]) -> DataFrame:
    """Line sources of several topics as one stream or table of (topic, line)."""
    return union_streams([
        rows.select(F.lit(topic).alias("topic"), F.col("line")) for topic, rows in sources.items()
    ])


def message_handler(messages: DataFrame, handler: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The caller's DataFrame -> DataFrame function over message rows."""
    return messages.transform(handler)
