import pytest
from pyspark.sql import functions as F

from logtide.operators import parsers, rollups
from logtide.plans.inputs import Inputs
from logtide.session import new_folder
from logtide.sinks.tables import compact_sums, create_hourly_table, read_sums, write_batch, write_hours
from logtide.sources.streams import file_stream_scan
from logtide.streaming import jobs, minutes
from logtide.streaming.batches import RefreshingDimension, batch_function_sink, batch_moment, batch_table_sink


@pytest.fixture
def inputs(spark, data):
    return Inputs(spark, data)


@pytest.fixture
def media_folder(inputs):
    """Media lines in six files, so that one minute's lines arrive in several batches."""
    folder = inputs.new_folder("test-media")
    inputs.media_log().repartition(6).write.text(folder)
    return folder


def media_stream(spark, folder):
    lines = file_stream_scan(spark, folder, "value string", "text", max_files=1)
    return lines.withColumnRenamed("value", "line")


def test_many_batches_give_the_batch_answer(spark, inputs, media_folder, rows):
    out, checkpoint = inputs.new_folder("out"), inputs.new_folder("cp")
    channels = RefreshingDimension(inputs.channels)
    jobs.stream_media_traffic(media_stream(spark, media_folder), channels, out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).select("batch_id").distinct().count() >= 6
    columns = ["domain", "userid", "timestamp", "cs"]
    sums = read_sums(spark, out, ["domain", "timestamp"], "cs")
    batch = rollups.media_traffic_minute(parsers.parse_media_log(inputs.media_log()), inputs.channels())
    assert rows(sums, *columns) == rows(batch, *columns)


def test_late_lines_count_and_replays_and_compaction_keep_the_sums(spark, lines, rows):
    line = "edge1 [{}/Jan/2024:{}:00:07 +0000] 1 a.com live s1 10.0.0.1 172.16.0.1 PUBLISH rtmp://x \"args\" 100 - 1"
    hours = [("02", "05"), ("02", "06"), ("01", "01"), ("02", "05")]  # hours and a day out of order
    folder, out, checkpoint, folded = (new_folder(spark, n) for n in ("late", "out", "cp", "folded"))
    for day, hour in hours:
        lines(line.format(day, hour)).coalesce(1).write.mode("append").text(folder)
    channels = RefreshingDimension(lambda: spark.createDataFrame([("a.com", "u")], "domain string, userid string"))
    jobs.stream_media_traffic(media_stream(spark, folder), channels, out, checkpoint).awaitTermination()
    keys = ["domain", "timestamp"]
    got = rows(read_sums(spark, out, keys, "cs"), "timestamp", "cs", "userid")
    at = lambda day, hour: str(1704067200 + (day - 1) * 86400 + hour * 3600)
    assert got == sorted([(at(2, 5), 200, "u"), (at(2, 6), 100, "u"), (at(1, 1), 100, "u")])
    first = spark.read.parquet(f"{out}/batch_id=0")
    write_batch(spark.createDataFrame(first.collect(), first.schema), out, 0)
    assert rows(read_sums(spark, out, keys, "cs"), "timestamp", "cs", "userid") == got
    day = F.date_format(F.timestamp_seconds(F.col("timestamp").cast("bigint")), "yyyyMMdd")
    compact_sums(spark, out, folded, keys, "cs", day)
    assert rows(spark.read.parquet(folded), "timestamp", "cs", "userid") == got
    assert spark.read.parquet(folded).select("day").distinct().count() == 2


def test_stream_continues_from_its_checkpoint(spark, inputs, media_folder, rows):
    out, checkpoint = inputs.new_folder("out"), inputs.new_folder("cp")
    for _ in range(2):
        media = parsers.parse_media_log(media_stream(spark, media_folder))
        batch_function_sink(media, batch_table_sink(out), checkpoint).awaitTermination()
        inputs.media_log().limit(0).write.mode("append").text(media_folder)
    parsed = parsers.parse_media_log(inputs.media_log())
    assert spark.read.parquet(out).count() == parsed.count()


def test_replayed_batch_adds_nothing(spark):
    out = new_folder(spark, "replay")
    rows_ = spark.range(100).withColumn("h", (F.col("id") % 3).cast("string"))
    for batch_id in (0, 1, 1, 0):
        write_batch(rows_, out, batch_id, ["h"])
    assert spark.read.parquet(out).count() == 200


def test_hourly_table_by_batch_time(spark, inputs):
    folder, out, checkpoint = (inputs.new_folder(n) for n in ("access", "out", "cp"))
    inputs.access_log().write.text(folder)
    lines = file_stream_scan(spark, folder, "value string", "text").withColumnRenamed("value", "line")
    jobs.stream_hourly_table(lines, out, checkpoint, batch_time=True).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == parsers.parse_access_log(inputs.access_log()).count()
    assert stored.select("month_", "day_", "hour_").distinct().count() <= 2


def test_offset_ledger_per_batch(spark, inputs):
    folder, out, checkpoint = (inputs.new_folder(n) for n in ("messages", "out", "cp"))
    inputs.message().repartitionByRange(3, "msg_offset").write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    stream = file_stream_scan(spark, folder, schema, max_files=1)
    jobs.stream_offset_ledger(stream, out, checkpoint).awaitTermination()
    ledger = spark.read.parquet(out)
    assert ledger.select("batch_id").distinct().count() == 3
    lows = inputs.message().groupBy("topic", "partition_id").agg(F.min("msg_offset").alias("low"))
    stored = ledger.groupBy("topic", "partition_id").agg(F.min("start_offset").alias("low"))
    assert stored.exceptAll(lows).count() == 0 and lows.exceptAll(stored).count() == 0


def test_dimension_is_read_again_after_its_ttl(spark):
    now, reads = [0.0], []

    def load():
        reads.append(now[0])
        return spark.range(1)

    dimension = RefreshingDimension(load, ttl=3600, clock=lambda: now[0])
    for now[0] in (0.0, 10.0, 3600.0, 3601.0, 3700.0):
        dimension.rows()
    assert reads == [0.0, 3601.0]


def test_dimension_survives_a_replaced_source(spark, rows):
    source = new_folder(spark, "dim")
    spark.range(3).write.parquet(source)
    now = [0.0]
    dimension = RefreshingDimension(lambda: spark.read.parquet(source), ttl=60, clock=lambda: now[0])
    assert dimension.rows().count() == 3
    spark.range(10, 15).write.mode("overwrite").parquet(source)
    assert rows(dimension.rows()) == [(0,), (1,), (2,)]
    now[0] = 61.0
    assert dimension.rows().count() == 5


def test_hours_are_in_the_catalog_and_replays_replace(spark):
    out = new_folder(spark, "hours")
    table = "hours_" + out.rsplit("-", 1)[-1]
    create_hourly_table(spark, table, out, "id BIGINT", batches=True)
    batch = lambda low, high: spark.range(low, high).select("id", *[F.lit(v).alias(n) for n, v in (("month_", "202401"), ("day_", "01"))], F.format_string("%02d", F.col("id") % 2).alias("hour_"))
    for batch_id, rows_ in ((0, batch(0, 10)), (1, batch(10, 30)), (0, batch(0, 10))):
        write_hours(rows_, out, batch_id, table)
    assert sorted(r.id for r in spark.table(table).collect()) == list(range(30))
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 4
    spark.sql(f"DROP TABLE {table}")


LINE = "edge1 [02/Jan/2024:{}:{:02}:07 +0000] 1 a.com live s1 10.0.0.1 172.16.0.1 PUBLISH rtmp://x \"args\" {} - 1"


def test_minutes_close_once_and_later_lines_are_corrections(spark, lines):
    """Three batches: a minute, a later one, and late lines of the first; each line is in one row."""
    folder, out, checkpoint = (new_folder(spark, n) for n in ("minutes", "out", "cp"))
    def run(*texts):
        lines(*texts).coalesce(1).write.mode("append").text(folder)
        stream = file_stream_scan(spark, folder, "value string", "text").withColumnRenamed("value", "line")
        minutes.stream_media_minutes(stream, out, checkpoint, hold=0).awaitTermination()
        return spark.read.parquet(out)
    run(LINE.format("05", 1, 100), LINE.format("05", 1, 50))
    run(LINE.format("05", 2, 7))
    rows = run(LINE.format("05", 1, 30), LINE.format("05", 1, 3), LINE.format("05", 3, 1))
    first = 1704067200 + 86400 + 5 * 3600 + 60
    assert sorted((r.timestamp, r.kind, r.cs) for r in rows.collect()) == [
        (first, "closed", 150), (first, "correction", 33), (first + 60, "closed", 7), (first + 120, "closed", 1)]
    assert {r.timestamp: r.cs for r in minutes.minute_sums(rows).collect()} == {first: 183, first + 60: 7, first + 120: 1}
    # One table, however many batches there were; the session keeps its own state store.
    assert not [f for f in rows.inputFiles() if "batch_id" in f]
    assert spark.conf.get(minutes.STORE) != minutes.ROCKSDB


def test_marks_of_closed_minutes_expire(spark, lines):
    """After the time to live a minute opens again: nothing of it is left in the store, and no line is lost."""
    import time

    folder, out, checkpoint = (new_folder(spark, n) for n in ("minutes", "out", "cp"))
    for turn in range(2):
        lines(LINE.format("05", 1, 100 + turn)).coalesce(1).write.mode("append").text(folder)
        stream = file_stream_scan(spark, folder, "value string", "text").withColumnRenamed("value", "line")
        minutes.stream_media_minutes(stream, out, checkpoint, hold=0, ttl=0.5).awaitTermination()
        time.sleep(1)
    assert sorted((r.kind, r.cs) for r in spark.read.parquet(out).collect()) == [("closed", 100), ("closed", 101)]


def test_held_minutes_wait_for_their_time(spark, lines):
    import time

    folder, out, checkpoint = (new_folder(spark, n) for n in ("minutes", "out", "cp"))
    lines(LINE.format("05", 1, 100)).coalesce(1).write.text(folder)
    stream = file_stream_scan(spark, folder, "value string", "text").withColumnRenamed("value", "line")
    query = minutes.stream_media_minutes(stream, out, checkpoint, hold=4, interval="1 second")
    try:
        lines(LINE.format("05", 1, 11)).coalesce(1).write.mode("append").text(folder)
        ends, rows = time.time() + 60, []
        while not rows and time.time() < ends:
            time.sleep(1)
            rows = spark.read.schema(minutes.OUTPUT).parquet(out).collect()
    finally:
        query.stop()
    assert [(r.kind, r.cs) for r in rows] == [("closed", 111)]


def test_a_batch_keeps_its_first_time(spark):
    checkpoint = new_folder(spark, "cp")
    first = batch_moment(spark, checkpoint, 3, clock=lambda: 1704067199.0)
    assert batch_moment(spark, checkpoint, 3, clock=lambda: 1704070000.0) == first
    assert batch_moment(spark, checkpoint, 4, clock=lambda: 1704070000.0) != first


def test_a_replay_in_the_next_hour_leaves_the_rows_where_they_were(spark, lines, monkeypatch):
    import logtide.streaming.jobs as live

    folder, out, checkpoint = (new_folder(spark, n) for n in ("access", "out", "cp"))
    taken = []
    def action_of(stream, action, *rest):
        taken.append(action)
        return batch_function_sink(stream, action, *rest)
    monkeypatch.setattr(live, "batch_function_sink", action_of)
    lines("x").coalesce(1).write.text(folder)
    stream = file_stream_scan(spark, folder, "value string", "text").withColumnRenamed("value", "line")
    live.stream_hourly_table(stream, out, checkpoint, batch_time=True).awaitTermination()
    rows = spark.createDataFrame([("a", 1)], "domain string, timestamp bigint")
    for now in ("2024-01-01 00:59:59", "2024-01-01 01:00:10"):
        at = __import__("datetime").datetime.fromisoformat(now + "+00:00").timestamp()
        monkeypatch.setattr(live, "batch_moment", lambda s, c, b: batch_moment(s, c, b, clock=lambda: at))
        taken[0](rows, 7)
    assert [(r.hour_, r.domain) for r in spark.read.parquet(out).where("batch_id = 7").collect()] == [(r.hour_, "a") for r in spark.read.parquet(out).where("batch_id = 7").limit(1).collect()]
    assert spark.read.parquet(out).where("batch_id = 7").count() == 1


def test_old_copies_of_a_dimension_are_removed(spark):
    import os

    now = [0.0]
    channels = RefreshingDimension(lambda: spark.range(2), ttl=1, clock=lambda: now[0])
    copies = []
    for turn in range(5):
        now[0] = 10.0 * turn
        copies.append(channels.rows())
        assert copies[-1].count() == 2
    held = [os.path.exists(f) for f in channels._folders]
    assert len(held) == 2 and all(held)
