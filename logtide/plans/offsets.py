"""Stream positions over the message table."""

from pyspark.sql import functions as F

from ..operators import filters, offsets, parsers
from ..sources.messagelog import append_messages, log_range_fetch, log_scan, log_stream_scan
from ..streaming.batches import batch_function_sink, batch_table_sink
from .inputs import WHITE_TOPICS, Inputs
from .registry import register

USABLE_SQL = "(SELECT * FROM {MANIFEST} WHERE topic <> 't4' AND start_offset < end_offset)"


def _usable(inputs: Inputs):
    return filters.usable_offset_ranges(parsers.parse_offset_manifest(inputs.offset_info()), WHITE_TOPICS)


@register("offset_range_fetch", f"""
    SELECT m.topic AS topic, m.partition_id AS partition_id, m.msg_offset AS msg_offset, m.value AS value
    FROM {{MESSAGE}} m JOIN {USABLE_SQL} r ON m.topic = r.topic AND m.partition_id = r.partition_id
      AND m.msg_offset >= r.start_offset AND m.msg_offset < r.end_offset""")
def offset_range_fetch(inputs: Inputs):
    return offsets.offset_range_fetch(inputs.message(), _usable(inputs))


@register("explode_requests", f"""
    SELECT r.topic AS topic, r.partition_id AS partition_id, r.start_offset AS start_offset,
      r.end_offset AS end_offset, count(*) AS messages
    FROM {USABLE_SQL} r JOIN {{MESSAGE}} m ON m.topic = r.topic AND m.partition_id = r.partition_id
      AND m.msg_offset >= r.start_offset AND m.msg_offset < r.end_offset GROUP BY ALL""")
def explode_requests(inputs: Inputs):
    exploded = offsets.explode_requests(_usable(inputs), inputs.message())
    return exploded.groupBy("topic", "partition_id", "start_offset", "end_offset").agg(
        F.count("*").alias("messages")
    )


@register("stream_resume_scan", """
    SELECT m.topic AS topic, m.partition_id AS partition_id, m.msg_offset AS msg_offset
    FROM {MESSAGE} m JOIN {MANIFEST} r ON m.topic = r.topic AND m.partition_id = r.partition_id
      AND m.msg_offset >= r.start_offset""")
def stream_resume_scan(inputs: Inputs):
    ledger = parsers.parse_offset_manifest(inputs.offset_info()).select(
        "topic", "partition_id", "start_offset"
    )
    return offsets.resume_from(inputs.message(), ledger).select("topic", "partition_id", "msg_offset")


@register("check_offset_bounds", """
    SELECT r.topic AS topic, r.partition_id AS partition_id, start_offset - 100 AS start_offset, end_offset, low, high
    FROM {MANIFEST} r JOIN (SELECT topic, partition_id, min(msg_offset) AS low, max(msg_offset) + 1 AS high
                            FROM {MESSAGE} GROUP BY ALL) b
      ON r.topic = b.topic AND r.partition_id = b.partition_id
    WHERE NOT (low <= start_offset - 100 AND end_offset <= high)""")
def check_offset_bounds(inputs: Inputs):
    # Starts are moved back by 100, before the first message of every partition.
    early = parsers.parse_offset_manifest(inputs.offset_info()).withColumn(
        "start_offset", F.col("start_offset") - 100
    )
    return offsets.check_offset_bounds(early, inputs.message())


@register("missing_partitions", """
    SELECT DISTINCT topic, partition_id FROM {MANIFEST} EXCEPT
    SELECT topic, partition_id FROM {MESSAGE} WHERE value <> 'no time' AND msg_offset % 12 <> 7""")
def missing_partitions(inputs: Inputs):
    requested = parsers.parse_offset_manifest(inputs.offset_info())
    found = parsers.hour_key(inputs.message()).where("partition_id <> 7")
    return offsets.missing_partitions(requested, found)


LEDGER_SQL = """
    (SELECT topic, string_agg(concat(partition_id, ':', from_offset), ',' ORDER BY partition_id) AS ledger
     FROM (SELECT topic, partition_id, min(msg_offset) AS from_offset FROM {MESSAGE} GROUP BY ALL) GROUP BY topic)"""


@register("save_offset_ledger", f"SELECT topic, ledger FROM {LEDGER_SQL}")
def save_offset_ledger(inputs: Inputs):
    return offsets.save_offset_ledger(inputs.message())


@register("load_offset_ledger", """
    SELECT topic, partition_id, min(msg_offset) AS start_offset FROM {MESSAGE} GROUP BY ALL""")
def load_offset_ledger(inputs: Inputs):
    return offsets.load_offset_ledger(offsets.save_offset_ledger(inputs.message()))


@register("starting_offsets_json", """
    SELECT concat('{', string_agg(concat('"', topic, '":{', parts, '}'), ',' ORDER BY topic), '}')
      AS starting_offsets
    FROM (SELECT topic, string_agg(concat('"', partition_id, '":', start_offset), ','
            ORDER BY CAST(partition_id AS VARCHAR)) AS parts
          FROM (SELECT topic, partition_id, min(msg_offset) AS start_offset FROM {MESSAGE} GROUP BY ALL)
          GROUP BY topic)""")
def starting_offsets_json(inputs: Inputs):
    return offsets.starting_offsets_json(offsets.save_offset_nodes(inputs.message()))


# Stored messages, one folder per partition id: a stream that takes one file a batch reads one partition at a time.
INTAKE_SQL = """
    SELECT topic, partition_id, min(msg_offset) AS start_offset, max(msg_offset) + 1 AS end_offset,
      count(*) AS messages, true AS bounded
    FROM {MESSAGE} GROUP BY topic, partition_id"""


def _stored_batches(inputs: Inputs, **limit):
    """Messages read again as a stream whose source bounds each batch, stored under the batch's id."""
    log, out, checkpoint = (inputs.new_folder(f"intake-{name}") for name in ("log", "out", "checkpoint"))
    placed = inputs.message().withColumn("_file", F.col("partition_id"))
    placed.repartition("_file").write.partitionBy("_file").parquet(log)
    schema = placed.drop("_file").schema
    reader = inputs.spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    for name, value in limit.items():
        reader = reader.option(name, value)
    batch_function_sink(reader.parquet(log), batch_table_sink(out), checkpoint).awaitTermination()
    return inputs.spark.read.parquet(out)


def _ranges(stored):
    ranges = offsets.batch_ranges(stored)
    held = ranges.groupBy("batch_id").agg(F.max("partition_id").alias("_high"), F.min("partition_id").alias("_low"))
    bounded = held.agg(F.max(F.col("_high") - F.col("_low")) == 0).scalar()
    return ranges.select(*offsets.PARTITION, "start_offset", "end_offset", "messages", bounded.alias("bounded"))


@register("intake_ranges", INTAKE_SQL)
def intake_ranges(inputs: Inputs):
    return _ranges(_stored_batches(inputs, maxFilesPerTrigger=1))


@register("intake_ranges_by_backlog", INTAKE_SQL)
def intake_ranges_by_backlog(inputs: Inputs):
    return _ranges(_stored_batches(inputs, maxBytesPerTrigger="1"))


@register("bounded_intake", "SELECT topic, partition_id, msg_offset, value FROM {MESSAGE}")
def bounded_intake(inputs: Inputs):
    return _stored_batches(inputs, maxFilesPerTrigger=5).select(*offsets.PARTITION, "msg_offset", "value")


# Offsets per segment of the stored logs.
SEGMENT = 50_000


def _stored_log(inputs: Inputs) -> str:
    log = inputs.new_folder("message-log")
    append_messages(inputs.message(), log, SEGMENT)
    return log


@register("log_scan", """
    SELECT m.topic AS topic, m.partition_id AS partition_id, m.msg_offset AS msg_offset, m.value AS value
    FROM {MESSAGE} m JOIN {MANIFEST} r ON m.topic = r.topic AND m.partition_id = r.partition_id
      AND m.msg_offset >= r.start_offset""")
def log_scan_query(inputs: Inputs):
    """A bounded read of the stored log from the positions of the manifest to its end."""
    starts = parsers.parse_offset_manifest(inputs.offset_info()).select("topic", "partition_id", "start_offset")
    starting = offsets.starting_offsets_json(starts).first().starting_offsets
    return log_scan(inputs.spark, _stored_log(inputs), SEGMENT, starting)


@register("log_range_fetch", f"""
    SELECT r.topic AS topic, r.partition_id AS partition_id, m.msg_offset AS msg_offset, m.value AS value,
      r.start_offset AS start_offset, r.end_offset AS end_offset
    FROM {USABLE_SQL} r JOIN {{MESSAGE}} m ON m.topic = r.topic AND m.partition_id = r.partition_id
      AND m.msg_offset >= r.start_offset AND m.msg_offset < r.end_offset""")
def log_range_fetch_query(inputs: Inputs):
    return log_range_fetch(inputs.spark, _stored_log(inputs), _usable(inputs), SEGMENT)


@register("log_stream_scan", "SELECT topic, partition_id, msg_offset, value FROM {MESSAGE}")
def log_stream_scan_query(inputs: Inputs):
    """The stored log as a stream, half of it appended after the first run: the second one resumes from the checkpoint."""
    log, out, checkpoint = (inputs.new_folder(f"log-{name}") for name in ("messages", "out", "checkpoint"))
    messages = inputs.message()
    middle = messages.agg(F.percentile_approx("msg_offset", 0.5)).first()[0]
    for part in (F.col("msg_offset") <= middle, F.col("msg_offset") > middle):
        append_messages(messages.where(part), log, SEGMENT)
        rows = log_stream_scan(inputs.spark, log, SEGMENT)
        batch_function_sink(rows, batch_table_sink(out), checkpoint).awaitTermination()
    return inputs.spark.read.parquet(out).select(*offsets.PARTITION, "msg_offset", "value")
