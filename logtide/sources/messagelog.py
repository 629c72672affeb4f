"""Stored message logs with offsets: written by Spark, read by position as a table, a stream or ranges.

A log is a folder of Parquet files under ``topic=/partition_id=/segment=``. A segment holds the messages of ``size``
consecutive offsets, so a range of offsets names the folders to be read. Offsets of a
partition only grow. Positions are JSON as for Kafka, ``{"topic": {"0": 17}}``: the next offset to be read.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "message_log"
SCHEMA = "topic string, partition_id int, msg_offset long, value string"
SEGMENT = 100_000
_ARROW = pa.schema([("topic", pa.string()), ("partition_id", pa.int32()), ("msg_offset", pa.int64()), ("value", pa.string())])


def append_messages(messages: DataFrame, path: str, size: int = SEGMENT) -> None:
    """Append messages (topic, partition_id, msg_offset, value) to a log; one task writes a segment, in the order of its offsets."""
    placed = messages.select(
        F.col("topic").cast("string"), F.col("partition_id").cast("int"), F.col("msg_offset").cast("long"),
        F.col("value").cast("string"), F.floor(F.col("msg_offset") / size).cast("long").alias("segment"))
    folders = ["topic", "partition_id", "segment"]
    ordered = placed.repartition(*folders).sortWithinPartitions(*folders, "msg_offset")
    ordered.write.mode("append").partitionBy(*folders).parquet(path)


def _opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("/"):
        return arrow_fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), unquote(path.removeprefix("file:").replace("///", "/", 1))
    return arrow_fs.FileSystem.from_uri(path)


def _children(store: arrow_fs.FileSystem, folder: str, name: str) -> dict[str, str]:
    """Value -> path of the folders ``name=value`` below a folder."""
    infos = store.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True))
    found = (posixpath.basename(i.path).partition("=") for i in infos if i.type == arrow_fs.FileType.Directory)
    return {unquote(v): f"{folder}/{k}={v}" for k, _, v in found if k == name}


def _files(store: arrow_fs.FileSystem, folder: str) -> list[str]:
    infos = store.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True))
    return sorted(i.path for i in infos if i.type == arrow_fs.FileType.File and posixpath.basename(i.path).startswith("part-"))


def _offsets_of(store: arrow_fs.FileSystem, folder: str) -> tuple[int, int]:
    """Smallest and largest offset of a segment, from the statistics of its files."""
    low, high = [], []
    for path in _files(store, folder):
        about = pq.read_metadata(store.open_input_file(path))
        at = about.schema.names.index("msg_offset")
        for group in range(about.num_row_groups):
            statistics = about.row_group(group).column(at).statistics
            low.append(statistics.min)
            high.append(statistics.max)
    return min(low), max(high)


def _ends(path: str, last: bool) -> dict[tuple[str, int], int]:
    """Per partition the offset after its last message, or that of its first one: one segment a partition is looked into."""
    store, root = _opened(path)
    out = {}
    for topic, of_topic in _children(store, root, "topic").items():
        for partition, folder in _children(store, of_topic, "partition_id").items():
            segments = {int(s): f for s, f in _children(store, folder, "segment").items()}
            for number in sorted(segments, reverse=last):
                if _files(store, segments[number]):  # a folder whose first file is still being written holds nothing yet
                    low, high = _offsets_of(store, segments[number])
                    out[topic, int(partition)] = high + 1 if last else low
                    break
    return out


def _position(text: str | None, path: str, default: str) -> dict[tuple[str, int], int]:
    text = text or default
    if text in ("earliest", "latest"):
        return _ends(path, last=text == "latest")
    return {(topic, int(p)): int(at) for topic, held in json.loads(text).items() for p, at in held.items()}


def _told(position: dict[tuple[str, int], int]) -> dict:
    out: dict = defaultdict(dict)
    for (topic, partition), at in sorted(position.items()):
        out[topic][str(partition)] = at
    return dict(out)


def _known(told: dict) -> dict[tuple[str, int], int]:
    return {(topic, int(p)): int(at) for topic, held in told.items() for p, at in held.items()}


@dataclass
class Piece:
    """Offsets [start, end) within one segment."""

    topic: str
    partition: int
    segment: int
    start: int
    end: int


@dataclass
class Split(InputPartition):
    """What one task reads: a piece, or several small ones of together no more offsets than a segment."""

    pieces: list[Piece]


def _splits(pieces: list[Piece], size: int) -> list[Split]:
    out, held = [], 0
    for piece in pieces:
        width = piece.end - piece.start
        if not out or held + width > size:
            out.append(Split([]))
            held = 0
        out[-1].pieces.append(piece)
        held += width
    return out


def _pieces(start: dict[tuple[str, int], int], end: dict[tuple[str, int], int], size: int) -> list[Piece]:
    out = []
    for (topic, partition), until in end.items():
        since = start.get((topic, partition), 0)
        for segment in range(since // size, -(-until // size)):
            a, b = max(since, segment * size), min(until, (segment + 1) * size)
            if a < b:
                out.append(Piece(topic, partition, segment, a, b))
    return out


def _read(path: str, piece: Piece) -> Iterator[pa.RecordBatch]:
    """The messages of a piece, whole batches at a time."""
    store, root = _opened(path)
    topics = _children(store, root, "topic")
    if piece.topic not in topics:
        return
    folder = f"{topics[piece.topic]}/partition_id={piece.partition}/segment={piece.segment}"
    within = [("msg_offset", ">=", piece.start), ("msg_offset", "<", piece.end)]
    for file in _files(store, folder):
        rows = pq.read_table(file, columns=["msg_offset", "value"], filters=within, filesystem=store, partitioning=None)
        for batch in rows.to_batches():
            n = batch.num_rows
            columns = [pa.array([piece.topic] * n, pa.string()), pa.array([piece.partition] * n, pa.int32()),
                       batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _read_split(path: str, split: Split | None) -> Iterator[pa.RecordBatch]:
    for piece in split.pieces if split else []:  # Spark passes None where there is nothing to read
        yield from _read(path, piece)


class LogReader(DataSourceReader):
    """A bounded read from ``startingOffsets`` to ``endingOffsets`` (default: all there is)."""

    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("segmentsize", SEGMENT))
        self.start, self.end = options.get("startingoffsets"), options.get("endingoffsets")

    def partitions(self) -> list[Split]:
        start = _position(self.start, self.path, "earliest")
        end = _position(self.end, self.path, "latest")
        if self.start not in (None, "earliest", "latest"):
            end = {p: at for p, at in end.items() if p in start}  # exactly the named partitions
        return _splits(_pieces(start, end, self.size), self.size)

    def read(self, split: Split | None) -> Iterator[pa.RecordBatch]:
        return _read_split(self.path, split)


class LogStreamReader(DataSourceStreamReader):
    """The log as it grows, from ``startingOffsets`` on.

    With ``maxOffsetsPerPartition`` a batch takes at most as many offsets of each partition. Spark asks for the
    next end without telling the last one, so each end is kept in ``positionFile``
    before Spark learns of it: a restarted query goes on from there, after the batch that its checkpoint
    repeats, and no position ever goes back.
    """

    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("segmentsize", SEGMENT))
        self.start, self.limit = options.get("startingoffsets"), int(options.get("maxoffsetsperpartition", 0))
        self.file = options.get("positionfile")
        if self.limit and not self.file:
            raise ValueError("maxOffsetsPerPartition needs a positionFile")

    def initialOffset(self) -> dict:
        return _told(_position(self.start, self.path, "earliest"))

    def latestOffset(self) -> dict:
        latest = _ends(self.path, last=True)
        if not self.limit:
            return _told(latest)
        first = _ends(self.path, last=False)
        reached = self._kept()
        if reached is None:
            reached = _position(self.start, self.path, "earliest")
        named = {p: max(at, reached.get(p, first[p])) for p, at in latest.items()}
        end = {p: min(at, max(reached.get(p, 0), first[p]) + self.limit) for p, at in named.items()} | {
            p: at for p, at in reached.items() if p not in latest}
        self._keep(end)
        return _told(end)

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return _splits(_pieces(_known(start), _known(end), self.size), self.size)

    def read(self, split: Split | None) -> Iterator[pa.RecordBatch]:
        return _read_split(self.path, split)

    def commit(self, end: dict) -> None:
        """Nothing to release: positions are kept when they are given out, and messages stay in the log."""

    def _kept(self) -> dict[tuple[str, int], int] | None:
        store, file = _opened(self.file)
        if store.get_file_info(file).type != arrow_fs.FileType.File:
            return None
        with store.open_input_file(file) as f:
            return _known(json.loads(f.read()))

    def _keep(self, position: dict[tuple[str, int], int]) -> None:
        store, file = _opened(self.file)
        store.create_dir(posixpath.dirname(file), recursive=True)
        part = f"{file}.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            out.write(json.dumps(_told(position)).encode())
        store.move(part, file)


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)


def log_scan(spark: SparkSession, path: str, size: int = SEGMENT, starting: str = "earliest", ending: str = "latest") -> DataFrame:
    """The messages of ``[starting, ending)``; offsets JSON names the partitions that are read."""
    spark.dataSource.register(MessageLog)
    options = {"path": path, "segmentSize": size, "startingOffsets": starting, "endingOffsets": ending}
    return spark.read.format(FORMAT).options(**options).load()


def log_stream_scan(
    spark: SparkSession, path: str, size: int = SEGMENT, starting: str = "earliest", limit: int = 0, position_file: str | None = None
) -> DataFrame:
    """The log as a stream; ``limit`` bounds the offsets that a batch takes of a partition, see ``LogStreamReader``."""
    spark.dataSource.register(MessageLog)
    reader = spark.readStream.format(FORMAT).options(path=path, segmentSize=size, startingOffsets=starting)
    if limit:
        reader = reader.options(maxOffsetsPerPartition=limit, positionFile=position_file)
    return reader.load()


def _spread(start: Column, end: Column, size: int) -> Column:
    return F.explode(F.sequence(F.floor(start / size), F.floor((end - 1) / size)))


def log_range_fetch(spark: SparkSession, path: str, ranges: DataFrame, size: int = SEGMENT, tasks: int | None = None) -> DataFrame:
    """The messages of each range (topic, partition_id, start_offset, end_offset): one row per range and message.

    Each range becomes its segments, and a task reads the segments that it is dealt, as Arrow batches: messages
    are neither scanned nor joined outside of the ranges. Overlapping ranges repeat
    their messages; ranges that are empty, negative or lack a value give none.
    """
    whole = ranges.where((F.col("start_offset") < F.col("end_offset")) & (F.col("start_offset") >= 0))
    bounds = ["topic", "partition_id", "start_offset", "end_offset"]
    pieces = whole.select(
        F.col("topic").cast("string"), F.col("partition_id").cast("int"), F.col("start_offset").cast("long"), F.col("end_offset").cast("long"),
    ).select(*bounds, _spread(F.col("start_offset"), F.col("end_offset"), size).alias("segment")).dropna()
    place = F.xxhash64(*bounds, "segment", F.monotonically_increasing_id())
    dealt = pieces.repartition(tasks, place) if tasks else pieces.repartition(place)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                since, until = max(r["start_offset"], r["segment"] * size), min(r["end_offset"], (r["segment"] + 1) * size)
                for found in _read(path, Piece(r["topic"], r["partition_id"], r["segment"], since, until)):
                    for name in ("start_offset", "end_offset"):
                        found = found.append_column(pa.field(name, pa.int64()), pa.array([r[name]] * found.num_rows, pa.int64()))
                    yield found

    return dealt.mapInArrow(fetch, f"{SCHEMA}, start_offset long, end_offset long")
