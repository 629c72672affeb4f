"""Streaming jobs run to the end of the present data, then read back."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from ..operators import offsets, parsers
from ..sinks.tables import create_hourly_table, read_sums
from ..operators.lookups import attach_userid
from ..streaming import jobs, minutes
from ..streaming.batches import RefreshingDimension, batch_function_sink, batch_table_sink
from ..streaming.versions import VersionedDimension, stream_media_as_of
from .inputs import Inputs
from .parsing import ACCESS_SQL, MEDIA_SQL
from .registry import register
from .rollups import MEDIA_MINUTE_SQL


def _folders(inputs: Inputs, label: str) -> tuple[str, str]:
    return inputs.new_folder(f"{label}-out"), inputs.new_folder(f"{label}-checkpoint")


@register("stream_scan", "SELECT event_id, event_type FROM events")
def stream_scan(inputs: Inputs):
    out, checkpoint = _folders(inputs, "stream-scan")
    rows = inputs.stream("events").select("event_id", "event_type")
    query = (
        rows.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return inputs.spark.read.parquet(out)


@register("stream_media_traffic", MEDIA_MINUTE_SQL)
def stream_media_traffic(inputs: Inputs):
    out, checkpoint = _folders(inputs, "stream-media")
    channels = RefreshingDimension(inputs.channels)
    lines = inputs.media_log(inputs.stream("events"))
    jobs.stream_media_traffic(lines, channels, out, checkpoint).awaitTermination()
    sums = read_sums(inputs.spark, out, ["domain", "timestamp"], "cs")
    return sums.select("domain", "userid", "timestamp", "cs")


@register("stream_media_minutes", MEDIA_MINUTE_SQL)
def stream_media_minutes(inputs: Inputs):
    out, checkpoint = _folders(inputs, "stream-minutes")
    lines = inputs.media_log(inputs.stream("events"))
    minutes.stream_media_minutes(lines, out, checkpoint, hold=0).awaitTermination()
    sums = attach_userid(minutes.minute_sums(inputs.spark.read.parquet(out)), inputs.channels())
    return sums.select("domain", "userid", F.col("timestamp").cast("string").alias("timestamp"), "cs")


@register("stream_hourly_table", f"""
    SELECT domain, dir1, dir2, timestamp, cs,
      strftime(make_timestamp(timestamp * 1000000), '%Y%m') AS month_,
      strftime(make_timestamp(timestamp * 1000000), '%d') AS day_,
      strftime(make_timestamp(timestamp * 1000000), '%H') AS hour_ FROM ({ACCESS_SQL})""")
def stream_hourly_table(inputs: Inputs):
    out, checkpoint = _folders(inputs, "stream-hourly")
    lines = inputs.access_log(inputs.stream("events"))
    table = "hourly_" + out.rsplit("-", 1)[-1]
    columns = "domain STRING, dir1 STRING, dir2 STRING, timestamp BIGINT, cs BIGINT"
    create_hourly_table(inputs.spark, table, out, columns, batches=True)
    jobs.stream_hourly_table(lines, out, checkpoint, table=table).awaitTermination()
    return inputs.spark.table(table).drop("batch_id")


@register("stream_relay", """
    SELECT concat('CDNLOG_cache h', user_id % 9, ' KS_FWLOG_TAG GET ', event_id, ' 10.1.0.', user_id % 256,
      ' 10.1.0.', user_id % 256) AS value FROM events WHERE event_type <> 'error'""")
def stream_relay(inputs: Inputs):
    out, checkpoint = _folders(inputs, "stream-relay")
    lines = inputs.firewall_log(inputs.stream("events"))
    jobs.stream_relay(lines, out, "relayed", checkpoint, format="parquet").awaitTermination()
    return inputs.spark.read.parquet(f"{out}/relayed").select("value")


@register("batch_function_sink", MEDIA_SQL)
def batch_function(inputs: Inputs):
    out, checkpoint = _folders(inputs, "batch-function")
    media = parsers.parse_media_log(inputs.media_log(inputs.stream("events")))
    batch_function_sink(media, batch_table_sink(out), checkpoint).awaitTermination()
    return inputs.spark.read.parquet(out).drop("batch_id")


@register("stream_offset_ledger", """
    SELECT topic, partition_id, min(msg_offset) AS start_offset FROM {MESSAGE} GROUP BY ALL""")
def stream_offset_ledger(inputs: Inputs):
    out, checkpoint = _folders(inputs, "stream-ledger")
    messages = inputs.message(inputs.stream("orders"))
    jobs.stream_offset_ledger(messages, out, checkpoint).awaitTermination()
    return inputs.spark.read.parquet(out).groupBy(*offsets.PARTITION).agg(
        F.min("start_offset").alias("start_offset")
    )


@register("refreshing_dimension", f"""
    SELECT m.domain AS domain, c.userid AS userid, m.flag AS flag, m.cs AS cs, m.timestamp AS timestamp
    FROM ({MEDIA_SQL}) m LEFT JOIN {{CHANNEL}} c ON m.domain = c.domain""")
def refreshing_dimension(inputs: Inputs):
    out, checkpoint = _folders(inputs, "stream-dimension")
    media = parsers.parse_media_log(inputs.media_log(inputs.stream("events")))
    channels = RefreshingDimension(inputs.channels, ttl=3600)
    jobs.stream_with_dimension(media, channels, out, checkpoint).awaitTermination()
    return inputs.spark.read.parquet(out).select("domain", "userid", "flag", "cs", "timestamp")


@register("stream_media_as_of", MEDIA_MINUTE_SQL)
def stream_media_as_of_query(inputs: Inputs):
    out, checkpoint = _folders(inputs, "stream-as-of")
    channels = VersionedDimension(inputs.spark, inputs.new_folder("channel-versions"), inputs.channels, ["domain"])
    stream_media_as_of(inputs.media_log(inputs.stream("events")), channels, out, checkpoint).awaitTermination()
    sums = read_sums(inputs.spark, out, ["domain", "timestamp"], "cs")
    return sums.select("domain", "userid", "timestamp", "cs")


READINGS = [datetime(2024, 1, 1, hour, tzinfo=timezone.utc) for hour in (0, 6, 12)]


@register("versioned_channels", """
    SELECT 1 AS reading, concat('c', c_custkey, '.example.com') AS domain,
      concat('u', CASE WHEN c_custkey % 5 < 1 THEN c_custkey + 1 ELSE c_custkey END) AS userid
    FROM customer WHERE c_custkey % 7 <> 4
    UNION ALL SELECT 2, concat('c', c_custkey, '.example.com'),
      concat('u', CASE WHEN c_custkey % 5 < 2 THEN c_custkey + 1 ELSE c_custkey END)
    FROM customer WHERE c_custkey % 11 <> 5""")
def versioned_channels(inputs: Inputs):
    """Three readings, the versions that ended before the second one folded, then the states after the second and third."""
    now = iter(inputs.channel_states())
    channels = VersionedDimension(inputs.spark, inputs.new_folder("channel-versions"), lambda: next(now), ["domain"])
    for moment in READINGS:
        channels.refresh(moment)
    channels.forget(READINGS[1])
    states = [channels.rows(READINGS[i] + timedelta(hours=1)).select(F.lit(i).alias("reading"), "domain", "userid") for i in (1, 2)]
    return states[0].unionByName(states[1])
