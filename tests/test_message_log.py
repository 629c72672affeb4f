import json

import pytest
from pyspark.sql import functions as F

from logtide.operators import parsers
from logtide.session import new_folder
from logtide.sources.messagelog import LogStreamReader, append_messages, log_range_fetch, log_scan, log_stream_scan
from logtide.streaming.batches import batch_function_sink, batch_table_sink


@pytest.fixture
def message(spark):
    def make(rows):
        return spark.createDataFrame(rows, "topic string, partition_id int, msg_offset long, value string")

    return make


def numbered(topic, partition, offsets):
    return [(topic, partition, o, f"{topic}{partition}-{o}") for o in offsets]


ROWS = numbered("a b/c=%", 0, range(3, 47)) + numbered("t", 0, range(0, 10)) + numbered("t", 11, [5, 25, 26, 90]) + [("t", 2, 1, None)]


def test_reads_by_position(spark, message, rows):
    log = new_folder(spark, "log")
    append_messages(message(ROWS), log, 10)
    assert rows(log_scan(spark, log, 10)) == sorted(ROWS, key=repr)
    starting = json.dumps({"a b/c=%": {"0": 15}, "t": {"11": 26, "7": 0}})
    expected = [r for r in ROWS if (r[0] != "t" and r[2] >= 15) or (r[1] == 11 and r[2] >= 26)]
    assert rows(log_scan(spark, log, 10, starting)) == sorted(expected, key=repr)
    ending = json.dumps({"a b/c=%": {"0": 16}, "t": {"11": 26}})
    assert rows(log_scan(spark, log, 10, starting, ending), "msg_offset") == [(15,)]
    assert log_scan(spark, log, 10, "latest").count() == 0
    # A read takes the pieces of its segments as tasks.
    assert log_scan(spark, log, 10, json.dumps({"a b/c=%": {"0": 3}})).rdd.getNumPartitions() == 5


def test_ranges_equal_the_plain_loop(spark, message, rows):
    log = new_folder(spark, "log")
    append_messages(message(ROWS), log, 10)
    asked = [("t", 11, 0, 100), ("t", 11, 25, 26), ("t", 11, 26, 26), ("t", 11, 30, 20), ("t", 9, 0, 5), ("none", 0, 0, 5),
             ("a b/c=%", 0, 9, 31), ("a b/c=%", 0, 9, 31), (None, 0, 0, 5), ("t", 0, None, 5), ("t", 0, -5, 5)]
    ranges = spark.createDataFrame(asked, "topic string, partition_id int, start_offset long, end_offset long")
    expected = [(*m, a, b) for t, p, a, b in asked if None not in (t, a, b) and a >= 0 for m in ROWS if m[:2] == (t, p) and a <= m[2] < b]
    assert rows(log_range_fetch(spark, log, ranges, 10)) == sorted(expected, key=repr)
    assert rows(log_range_fetch(spark, log, ranges, 10, tasks=3)) == sorted(expected, key=repr)


def test_ranges_need_no_join(spark, message, plan_of):
    log = new_folder(spark, "log")
    append_messages(message(ROWS), log, 10)
    ranges = spark.createDataFrame([("t", 11, 0, 100)], "topic string, partition_id int, start_offset long, end_offset long")
    plan = plan_of(log_range_fetch(spark, log, ranges, 10))
    assert "Join" not in plan and "MapInArrow" in plan


def run(spark, log, out, checkpoint, **limits):
    stream = log_stream_scan(spark, log, 10, **limits)
    batch_function_sink(stream, batch_table_sink(out), checkpoint).awaitTermination()
    return spark.read.parquet(out)


def test_a_stream_resumes_and_meets_new_partitions(spark, message, rows):
    log, out, checkpoint = (new_folder(spark, n) for n in ("log", "out", "cp"))
    append_messages(message(numbered("t", 0, range(0, 15))), log, 10)
    starting = json.dumps({"t": {"0": 4}})
    assert rows(run(spark, log, out, checkpoint, starting=starting), "msg_offset") == [(o,) for o in sorted(range(4, 15), key=lambda o: repr((o,)))]
    append_messages(message(numbered("t", 0, range(15, 33)) + numbered("u", 3, [7, 8])), log, 10)
    for _ in range(2):  # the second time there is nothing new
        found = run(spark, log, out, checkpoint)
        assert rows(found, "topic", "msg_offset") == sorted([("t", o) for o in range(4, 33)] + [("u", 7), ("u", 8)], key=repr)
    assert found.groupBy("batch_id").count().count() == 2


def test_a_batch_takes_at_most_its_limit(spark, message, rows):
    log, out, checkpoint = (new_folder(spark, n) for n in ("log", "out", "cp"))
    positions = new_folder(spark, "positions") + "/next.json"
    append_messages(message(numbered("t", 0, range(100, 125)) + numbered("t", 1, range(0, 8))), log, 10)
    with pytest.raises(ValueError):
        LogStreamReader({"path": log, "maxoffsetsperpartition": "10"})
    for _ in range(4):
        found = run(spark, log, out, checkpoint, limit=10, position_file=positions)
    sizes = found.groupBy("batch_id", "partition_id").agg(F.count("*").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 10
    assert rows(found, "partition_id", "msg_offset") == sorted([(0, o) for o in range(100, 125)] + [(1, o) for o in range(8)], key=repr)


def test_variants_equal_the_plain_parse(spark, rows):
    texts = ['{"a":{"b":[1,2]},"c":"x"}', '{"a":{"b":["7"]},"c":5}', '{"a":{"b":[]},"c":"x"}', "{bad", None, '{"c":"x"}', '{"a":{"b":["no"]},"c":"x"}', '{"c":"x","a":{"b":[3]},"z":null}']
    table = spark.createDataFrame(list(enumerate(texts)), "n int, req string")
    found = parsers.variant_extract(table, "req", {"first": ("$.a.b[0]", "bigint"), "c": ("$.c", "string")}, keep=["n"])
    expected = []
    for n, text in enumerate(texts):
        try:
            value = json.loads(text)
            expected.append((n, int(value["a"]["b"][0]), str(value["c"])))
        except (TypeError, ValueError, KeyError, IndexError):
            pass
    assert rows(found, "n", "first", "c") == expected


def test_a_variant_is_parsed_once(spark, plan_of):
    table = spark.createDataFrame([("{}",)], "req string")
    found = parsers.variant_extract(table, "req", {k: (f"$.{k}", "string") for k in "abc"})
    assert plan_of(found).count("parseJson(") == 1
