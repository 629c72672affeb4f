import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logtide.operators import versions
from logtide.session import new_folder
from logtide.sinks.tables import read_sums
from logtide.streaming.batches import batch_moment
from logtide.streaming.versions import VersionedDimension, stream_media_as_of

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def plain_as_of(facts, held):
    """The greatest version of the last beginning at or before each fact."""
    out = []
    for number, key, at in facts:
        known = [(b, v) for k, b, v in held if k is not None and b is not None and k == key and at is not None and b <= at]
        out.append((number, max(known)[1] if known else None))
    return sorted(out)


@pytest.mark.parametrize("share", [versions.SHARE, 1 / 8])
def test_as_of_equals_the_plain_search(spark, monkeypatch, share):
    monkeypatch.setattr(versions, "SHARE", share)
    draw = random.Random(5)
    keys = ["hot"] * 6 + ["a", "b", "c", None, "none"]  # "hot" has most facts; "none" has no version
    facts = [(i, draw.choice(keys), draw.choice([None, *range(0, 40000, 7), 7200, 7200, 7200])) for i in range(3000)]
    held = [(draw.choice(["hot", "a", "b", "c", None]), draw.choice([None, *range(0, 30000, 11), 7200]), f"u{i}") for i in range(120)]
    held += [("a", 0, "twice"), ("a", 0, "twice"), ("a", 0, "less")]
    left = spark.createDataFrame(facts, "number int, key string, at long").repartition(5)
    right = spark.createDataFrame(held, "key string, valid_from long, user string")
    got = versions.as_of_join(left, right, ["key"], "at")
    expected = plain_as_of(facts, held)
    assert sorted((r.number, r.user) for r in got.collect()) == expected
    assert got.columns == ["number", "key", "at", "user"]
    inner = versions.as_of_join(left, right, ["key"], "at", how="inner", width=100)
    assert sorted((r.number, r.user) for r in inner.collect()) == [e for e in expected if e[1] is not None]


def test_as_of_of_empty_tables_and_clashing_names(spark):
    facts = spark.createDataFrame([("k", 5, 1), ("k", 5, 1)], "key string, at long, user int")
    held = spark.createDataFrame([("k", 5, "u", "x")], "key string, valid_from long, user string, other string")
    with pytest.raises(ValueError, match="user"):
        versions.as_of_join(facts, held, ["key"], "at")
    one = versions.as_of_join(facts, held, ["key"], "at", values=["other"])
    assert [tuple(r) for r in one.collect()] == [("k", 5, 1, "x")] * 2
    assert [r.other for r in versions.as_of_join(facts, held.limit(0), ["key"], "at", values=["other"]).collect()] == [None, None]
    assert versions.as_of_join(facts.limit(0), held, ["key"], "at", values=["other"]).count() == 0


def test_a_crowded_stretch_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(versions, "SHARE", 1 / 8)
    facts = spark.range(4000).select(F.lit("k").alias("key"), F.lit(10).cast("long").alias("at"), "id").repartition(4)
    held = spark.createDataFrame([("k", 3, "u"), ("k", 10, "v")], "key string, valid_from long, user string")
    named = versions.as_of_join(facts, held, ["key"], "at")
    assert named.groupBy("user").count().collect()[0]["count"] == 4000
    parts = named.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 4000


def at(hours):
    return START + timedelta(hours=hours)


def dimension(spark, path, states, ttl=3600.0):
    def load():
        return spark.createDataFrame(states.pop(0), "domain string, userid string")

    return VersionedDimension(spark, path, load, ["domain"], ttl)


def test_states_of_all_readings(spark, rows):
    path = new_folder(spark, "versions")
    states = [[("a", "1"), ("b", "1"), (None, "x")], [("a", "1"), ("b", "2"), ("c", "1"), ("c", "2")], [("b", "2")], [("a", "9")]]
    expected = [[("a", "1"), ("b", "1")], [("a", "1"), ("b", "2"), ("c", "2")], [("b", "2")], [("a", "9")]]
    mine = dimension(spark, path, list(states))
    with pytest.raises(ValueError):
        mine.rows(at(0))
    assert [mine.refresh(at(h)) for h in (0, 0.5, 2, 4, 4, 3, 6)] == [True, False, True, True, False, False, True]
    assert mine.versions().count() == 2 + 2 + 2 + 2  # only what differs is written
    for known in (mine, dimension(spark, path, [])):  # a new driver knows the same
        for i, hours in enumerate((0, 2, 4, 6)):
            assert rows(known.rows(at(hours + 1)), "domain", "userid") == expected[i]
    mine.forget(at(4))
    for i, hours in ((2, 4), (3, 6)):
        assert rows(mine.rows(at(hours + 1)), "domain", "userid") == expected[i]
    assert mine.versions().count() == 3  # b since the second reading; b gone and a back at the fourth
    assert [name.split("-")[0] for _, name in mine._folders()] == ["base"]
    again = dimension(spark, path, [[("a", "9"), ("z", "1")]])
    assert again.refresh(at(8)) and rows(again.rows(at(9)), "domain", "userid") == [("a", "9"), ("z", "1")]


def test_a_reading_that_broke_off_is_not_read(spark, rows):
    path = new_folder(spark, "versions")
    mine = dimension(spark, path, [[("a", "1")], [("a", "2")]])
    mine.refresh(at(0))
    broken = f"{path}/change-{int(at(1).timestamp() * 1e6):020d}"
    spark.createDataFrame([("a", "bad", at(1), True)], "domain string, userid string, valid_from timestamp, held boolean").write.parquet(broken)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop(f"{broken}/_SUCCESS"), False)
    assert rows(mine.rows(at(2)), "userid") == [("1",)]
    assert mine.refresh(at(2)) and rows(mine.rows(at(2)), "userid") == [("2",)]


def test_a_batch_that_is_run_again_meets_the_dimension_of_its_time(spark, lines, rows):
    line = 'edge1 [02/Jan/2024:05:00:07 +0000] 1 a.com live s1 10.0.0.1 172.16.0.1 PUBLISH rtmp://x "args" 100 - 1'
    folder, out, checkpoint, path = (new_folder(spark, n) for n in ("lines", "out", "cp", "versions"))
    clock = iter([at(0).timestamp(), at(5).timestamp()])
    states = [[("a.com", "old")], [("a.com", "new")]]

    def run():
        stream = spark.readStream.schema("line string").text(folder).withColumnRenamed("value", "line")
        stream_media_as_of(stream, dimension(spark, path, states), out, checkpoint, clock=lambda: next(clock)).awaitTermination()

    for _ in range(2):
        lines(line).coalesce(1).write.mode("append").text(folder)
        run()
    by_batch = spark.read.parquet(out)
    assert rows(by_batch, "batch_id", "userid") == [(0, "old"), (1, "new")]
    # Batch 0 again, as after a failure: its time is kept, and so is what held then.
    mine = dimension(spark, path, [])
    moment = batch_moment(spark, checkpoint, 0)
    assert not mine.refresh(moment) and rows(mine.rows(moment), "userid") == [("old",)]
    assert rows(read_sums(spark, out, ["domain", "timestamp"], "cs"), "cs", "userid") == [(200, "new")]
