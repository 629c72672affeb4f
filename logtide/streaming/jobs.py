"""The live jobs: traffic roll-up, hourly table, relay, position ledger, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import publish_only
from ..operators.lookups import attach_userid
from ..operators.offsets import save_offset_nodes
from ..operators.parsers import FIREWALL_TAG, parse_access_log, parse_media_log, reshape_firewall_log
from ..functions.times import batch_time_parts
from ..sinks.tables import HOUR_PARTITION, write_batch, write_hours
from ..sinks.text import keyed_messages
from .batches import RefreshingDimension, batch_function_sink, batch_moment


def media_traffic_batch(lines: DataFrame) -> DataFrame:
    """Published bytes by domain and event minute of one batch of lines."""
    media = publish_only(parse_media_log(lines, only="publish"))
    return media.groupBy("domain", "timestamp").agg(F.sum("cs").alias("cs"))


def stream_media_traffic(
    lines: DataFrame,
    channels: RefreshingDimension,
    path: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep published bytes per (domain, userid, minute) in ``path``, as partial sums per batch.

    Read the result with ``read_sums(path, ['domain', 'timestamp'], 'cs')``. A line counts
    however late it comes: a batch adds its own sums for every minute it touches, no state is
    held between batches, and a batch that runs again replaces its sums.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        named = attach_userid(media_traffic_batch(batch), channels.rows())
        write_batch(named.select("domain", "timestamp", "userid", "cs"), path, batch_id)

    return batch_function_sink(lines, action, checkpoint, "append", interval)


def stream_hourly_table(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    batch_time: bool = False,
    interval: str | None = None,
    table: str | None = None,
) -> StreamingQuery:
    """Parsed access lines under month_ / day_ / hour_, each hour's batches below it.

    The hour is the line's own; with ``batch_time`` it is that of the batch, taken once and kept beside
    the checkpoint, so that a batch that runs again has its first time. With ``table``
    (see ``create_hourly_table``) every hour that a batch wrote is put into the catalog. A
    batch that runs again replaces its rows, as each hour holds them under the batch's id.
    """
    parsed = parse_access_log(lines)

    def action(batch: DataFrame, batch_id: int) -> None:
        moment = F.lit(batch_moment(batch.sparkSession, checkpoint, batch_id)) if batch_time else F.timestamp_seconds("timestamp")
        parts = batch_time_parts(moment)
        placed = batch.withColumns({name: parts[name] for name in HOUR_PARTITION})
        write_hours(placed, path, batch_id, table)

    return batch_function_sink(parsed, action, checkpoint, "append", interval)


def stream_relay(
    lines: DataFrame,
    target: str,
    topic: str,
    checkpoint: str,
    tag: str = FIREWALL_TAG,
    format: str = "kafka",
    interval: str | None = None,
) -> StreamingQuery:
    """Reshaped firewall lines from one topic set to another."""
    messages = keyed_messages(reshape_firewall_log(lines, tag=tag))
    writer = messages.writeStream.format(format).outputMode("append")
    if format == "kafka":
        writer = writer.option("kafka.bootstrap.servers", target).option("topic", topic)
        writer = writer.option("kafka.acks", "all").option("kafka.compression.type", "snappy")
    else:
        writer = writer.option("path", f"{target}/{topic}")
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stream_offset_ledger(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Per batch, the first offset of every topic partition, as an audit table.

    Recovery itself uses the checkpoint.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        write_batch(save_offset_nodes(batch), path, batch_id)

    return batch_function_sink(messages, action, checkpoint, "append", interval)


def stream_with_dimension(
    media: DataFrame,
    channels: RefreshingDimension,
    path: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Each batch joined with the dimension as it stands then."""

    def action(batch: DataFrame, batch_id: int) -> None:
        write_batch(attach_userid(batch, channels.rows()), path, batch_id)

    return batch_function_sink(media, action, checkpoint, "append", interval)
