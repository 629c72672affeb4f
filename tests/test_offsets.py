import json

import pytest
from pyspark.sql import functions as F

from logtide.operators import offsets
from logtide.sources import streams


@pytest.fixture
def messages(spark):
    # Offsets 10..109 in partition 0 (with a gap at its end), 0..49 in partition 1.
    a = spark.range(10, 110).where("id < 100 OR id = 109").select(F.lit("t").alias("topic"), F.lit(0).alias("partition_id"), F.col("id").alias("msg_offset"))
    b = spark.range(50).select(F.lit("t").alias("topic"), F.lit(1).alias("partition_id"), F.col("id").alias("msg_offset"))
    return a.union(b).withColumn("value", F.col("msg_offset").cast("string"))


def ranges(spark, *made):
    return spark.createDataFrame(list(made), "topic string, partition_id int, start_offset bigint, end_offset bigint")


def test_fetch_excludes_the_end_and_survives_a_gap(spark, messages):
    got = offsets.offset_range_fetch(messages, ranges(spark, ("t", 0, 95, 105), ("t", 1, 0, 2), ("u", 0, 0, 9)))
    assert sorted((r.partition_id, r.msg_offset) for r in got.collect()) == [(0, 95), (0, 96), (0, 97), (0, 98), (0, 99), (1, 0), (1, 1)]


def test_overlapping_requests_repeat_messages(spark, messages):
    wanted = ranges(spark, ("t", 1, 0, 3), ("t", 1, 2, 4))
    assert offsets.explode_requests(wanted, messages).count() == 5


def test_resume_starts_at_the_stored_offset(spark, messages):
    ledger = spark.createDataFrame([("t", 1, 48)], "topic string, partition_id int, start_offset bigint")
    assert sorted(r.msg_offset for r in offsets.resume_from(messages, ledger).collect()) == [48, 49]


def test_bounds(spark, messages, rows):
    wanted = ranges(spark, ("t", 0, 10, 110), ("t", 0, 9, 20), ("t", 1, 0, 51), ("t", 2, 0, 1))
    got = rows(offsets.check_offset_bounds(wanted, messages), "partition_id", "start_offset", "low", "high")
    assert got == [(0, 9, 10, 110), (1, 0, 0, 50), (2, 0, None, None)]
    assert rows(offsets.missing_partitions(wanted, messages)) == [("t", 2)]


def test_ledger_round_trip(spark, messages, rows):
    ledger = offsets.save_offset_ledger(messages)
    assert rows(ledger) == [("t", "0:10,1:0")]
    assert rows(offsets.load_offset_ledger(ledger)) == [("t", 0, 10), ("t", 1, 0)]
    text = offsets.starting_offsets_json(offsets.load_offset_ledger(ledger)).first()[0]
    assert json.loads(text) == {"t": {"0": 10, "1": 0}}


def test_no_ledger_starts_at_the_latest(spark):
    nothing = spark.createDataFrame([], "topic string, partition_id int, start_offset bigint")
    assert offsets.starting_offsets_json(nothing).first()[0] == "latest"


def test_ranges_of_stored_batches(spark, rows):
    read = spark.createDataFrame([(0, "t", 1, 5), (0, "t", 1, 9), (1, "t", 1, 10), (1, "u", 2, 3)], "batch_id long, topic string, partition_id int, msg_offset long")
    assert rows(offsets.batch_ranges(read)) == [(0, "t", 1, 5, 10, 2), (1, "t", 1, 10, 11, 1), (1, "u", 2, 3, 4, 1)]


def test_stream_options():
    assert streams.starting_position("smallest") == "earliest"
    assert streams.starting_position("Smallest") == "earliest"
    assert streams.starting_position("largest") == streams.starting_position(None) == "latest"
    options = streams.kafka_options("h:1", ["a", "b"], "earliest", max_rate=5, batch_seconds=60, partitions=4)
    assert options["subscribe"] == "a,b" and options["maxOffsetsPerTrigger"] == "1200"
    assert "maxOffsetsPerTrigger" not in streams.kafka_options("h:1", ["a"], "latest")
