"""Text writers: archive, sorted CSV lines, plain lines and messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import archive_key
from ..operators.numbering import global_sort

ARCHIVE_PARTITION = ["y", "m", "d", "h"]


def hour_keyed_archive(
    lines: DataFrame, path: str, hour: str = "hour", line: str = "value", with_key: bool = True
) -> None:
    """Gzip text in one folder per hour, ``y=/m=/d=/h=``, lines as ``key<TAB>line``.

    ``hour`` is ``yyyy/MM/dd/HH``. A busy hour is spread over several files.
    """
    text = F.concat(archive_key(hour), F.lit("\t"), F.col(line)) if with_key else F.col(line)
    parts = F.split(hour, "/")
    placed = lines.select(
        text.alias("value"),
        *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(ARCHIVE_PARTITION)],
    )
    placed.hint("rebalance", *ARCHIVE_PARTITION).write.mode("append").partitionBy(
        *ARCHIVE_PARTITION
    ).option("compression", "gzip").text(path)


def keyed_messages(lines: DataFrame, line: str = "line") -> DataFrame:
    """key, value for a message sink.

    The key spreads lines over the topic's partitions. It is a hash of the
    line, so a retried task sends a line under the same key.
    """
    return lines.select(F.xxhash64(line).cast("string").alias("key"), F.col(line).alias("value"))


def message_sink(
    lines: DataFrame, target: str, topic: str, line: str = "line", format: str = "kafka"
) -> None:
    """Send every line to a topic: all replicas acknowledge, snappy on the wire.

    With another format, ``target`` is a folder that stands in for the topic.
    """
    messages = keyed_messages(lines, line)
    if format == "kafka":
        messages.write.format("kafka").option("kafka.bootstrap.servers", target).option(
            "topic", topic
        ).option("kafka.acks", "all").option("kafka.compression.type", "snappy").save()
    else:
        messages.write.format(format).mode("append").save(f"{target}/{topic}")


def csv_line_sink(df: DataFrame, path: str, columns: Sequence[str], order_by: Sequence[Column | str]) -> None:
    """``a,b,c`` lines in total order: part files in name order form one sorted file."""
    ordered = global_sort(df, *order_by)
    cells = [F.col(name).cast("string") for name in columns]
    ordered.select(F.concat_ws(",", *cells).alias("value")).write.mode("errorifexists").text(path)


def write_text(lines: DataFrame, path: str, append: bool = False, line: str = "line") -> None:
    """Replace a text path, or add to it (creating it when absent)."""
    lines.select(F.col(line).alias("value")).write.mode("append" if append else "overwrite").text(path)


def export_by_domain_day(lines: DataFrame, path: str, line: str = "value") -> None:
    """Text under ``domain=/day=/hour=`` for rows that carry those three columns."""
    lines.select(F.col(line).alias("value"), "domain", "day", "hour").hint(
        "rebalance", "domain", "day", "hour"
    ).write.mode("append").partitionBy("domain", "day", "hour").text(path)
