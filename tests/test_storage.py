import gzip
import pathlib

import pytest
from pyspark.sql import functions as F

from logtide import session
from logtide.sinks import tables as table_sinks
from logtide.sinks import text as text_sinks
from logtide.sources import tables


def local(path):
    return pathlib.Path(path.removeprefix("file:"))


def test_folders_come_from_the_named_shared_folder(spark, monkeypatch):
    class Named:
        conf = {"spark.checkpoint.dir": "hdfs://shared/cp/"}

    assert session.work_root(Named) == "hdfs://shared/cp"
    assert session.new_folder(Named, "x").startswith("hdfs://shared/cp/x-")

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(Cluster)


def test_archive_files_are_gzip_lines_with_key(spark):
    folder = session.new_folder(spark, "arch")
    df = spark.createDataFrame([("2024/01/02/03", "a"), ("2024/01/02/03", "b"), ("2024/01/02/04", "c")], "hour string, value string")
    text_sinks.hour_keyed_archive(df, folder)
    files = sorted(local(folder).glob("y=2024/m=01/d=02/h=03/*.gz"))
    found = sorted(line for f in files for line in gzip.open(f, "rt").read().splitlines())
    assert found == [f"2024/01/02/03_2024-01-02-03\t{x}" for x in "ab"]


def test_csv_lines_are_in_order_across_files(spark):
    folder = session.new_folder(spark, "csv")
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("user"), F.lit(1.5).alias("rate")).repartition(8)
    text_sinks.csv_line_sink(df, folder, ["user", "rate"], ["user"])
    found = [line for f in sorted(local(folder).glob("part-*")) for line in f.read_text().splitlines()]
    assert found == [f"{i},1.5" for i in range(1000)]


def test_matrix_lines(spark, lines):
    folder = session.new_folder(spark, "matrix")
    text_sinks.write_text(lines("1 2 3", "4 x", "-5"), folder)
    assert sorted(r.cells for r in tables.numeric_matrix_scan(spark, folder).collect()) == [[-5], [1, 2, 3]]
    with pytest.raises(Exception, match="malformed row"):
        tables.numeric_matrix_scan(spark, folder, strict=True).collect()


def test_text_modes(spark, lines):
    folder = session.new_folder(spark, "modes")
    text_sinks.write_text(lines("a"), folder, append=True)
    text_sinks.write_text(lines("b"), folder, append=True)
    assert tables.text_scan(spark, folder).count() == 2
    text_sinks.write_text(lines("c"), folder)
    assert [r.value for r in tables.text_scan(spark, [folder]).collect()] == ["c"]


def test_index_scan_reads_one_folder(spark, plan_of):
    root = session.new_folder(spark, "index")
    df = spark.createDataFrame([("d1", "100", 1), ("d1", "200", 2), ("d2", "300", 3)], "day string, timestamp string, cs int")
    table_sinks.dated_index_sink(df, root, "pno", F.col("day"))
    scan = tables.index_range_scan(spark, root, "pno", "d1", "150", "200")
    assert [r.cs for r in scan.collect()] == [2]
    plan = plan_of(scan)
    assert all("index_name=pno/index_date=d1/" in f for f in scan.inputFiles())
    assert "GreaterThanOrEqual(timestamp,150)" in plan


def test_index_append_repeats_rows(spark):
    root = session.new_folder(spark, "index")
    for _ in range(2):
        table_sinks.dated_index_sink(spark.range(3), root, "a", "20240101")
    assert spark.read.parquet(root).count() == 6


def test_partition_registration_is_idempotent(spark):
    folder = session.new_folder(spark, "tab")
    table = "t_" + folder.rsplit("-", 1)[-1]
    moment = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)
    table_sinks.hourly_parquet_append(spark.range(3), folder, moment)
    table_sinks.create_hourly_table(spark, table, folder, "id BIGINT")
    for _ in range(2):
        table_sinks.register_partition(spark, table, "202401", "01", "01")
    assert [r.id for r in spark.table(table).collect()] == [1]
    table_sinks.register_all_partitions(spark, table)
    assert spark.table(table).count() == 3


def test_message_keys_are_stable(lines, rows):
    source = lines("a", "b")
    assert rows(text_sinks.keyed_messages(source)) == rows(text_sinks.keyed_messages(source))


def test_inventory_reads_names_and_sizes_only(spark, lines, plan_of):
    folder = session.new_folder(spark, "inv")
    text_sinks.write_text(lines("abc"), f"{folder}/a/b")
    files = tables.file_inventory(spark, folder)
    assert [(r.path.split("part-")[0], r.length) for r in files.collect() if "part-" in r.path] == [("a/b/", 4)]
    assert "content" not in plan_of(files)


def test_inventory_of_a_root_whose_name_comes_again(spark, lines):
    folder = session.new_folder(spark, "inv") + "/data"
    text_sinks.write_text(lines("abc"), f"{folder}/mydata/data/x")
    for root in (folder, folder + "/", f"file://{folder}"):
        names = [r.path for r in tables.file_inventory(spark, root).collect() if "part-" in r.path]
        assert [n.split("/part-")[0] for n in names] == ["mydata/data/x"]


def test_a_file_delivered_twice_has_one_row(spark, rows):
    from logtide.operators import delivery

    plan = spark.createDataFrame([("/a", 5), ("/b", 7), ("/c", 9)], "target string, size bigint")
    log = spark.createDataFrame([("/a", 0), ("/a", 5), ("/b", 3), ("/b", 4)], "path string, size bigint")
    got = rows(delivery.reconcile_delivery(plan, log), "target", "delivered_size", "status")
    assert got == [("/a", 5, "ok"), ("/b", 4, "short"), ("/c", 0, "failed")]


def test_offsets_name_the_partitions_to_read():
    from logtide.sources import streams

    some = '{"t": {"3": 10, "1": 5}, "u": {"0": 2}}'
    options = streams.kafka_options("h:1", ["t", "u"], some, max_rate=10, batch_seconds=2)
    assert options["assign"] == '{"t": [1, 3], "u": [0]}' and "subscribe" not in options
    assert options["maxOffsetsPerTrigger"] == "60"
    assert streams.kafka_options("h:1", ["t", "u"], "latest")["subscribe"] == "t,u"
    with pytest.raises(ValueError, match="number of partitions"):
        streams.kafka_options("h:1", ["t"], "latest", max_rate=10, batch_seconds=2)
    with pytest.raises(ValueError, match="different partitions"):
        streams.offset_range_read(None, "h:1", ["t"], some, '{"t": {"1": 9}}')
