"""Live minutes with keyed state: each minute is given out once, later lines as corrections.

State is held per domain and minute in the state store. A minute stays open for ``hold``
seconds from its first line, then its sum is given out and only a mark stays, for ``ttl`` seconds. Lines
that come while the mark stands are given out at once as corrections; lines after
that open the minute again. Every line is in exactly one row, so the sum of all rows of a
minute is the sum of its lines, whatever their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.filters import publish_only
from ..operators.parsers import parse_media_log

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
OUTPUT = "domain string, timestamp bigint, cs bigint, kind string"


class MinuteSums(StatefulProcessor):
    """(domain, minute) -> one ``closed`` row, then ``correction`` rows."""

    def __init__(self, hold: float, ttl: float):
        self.hold, self.ttl = int(hold * 1000), int(ttl * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # An open sum never expires by itself, so none is lost while the query is down.
        self.open = handle.getValueState("open", "cs bigint")
        self.closed = handle.getValueState("closed", "since bigint", self.ttl)

    def _row(self, key, cs: int, kind: str) -> pd.DataFrame:
        return pd.DataFrame({"domain": [key[0]], "timestamp": [key[1]], "cs": [cs], "kind": [kind]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        added = sum(int(part["cs"].sum()) for part in rows)
        if self.closed.exists():
            yield self._row(key, added, "correction")
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.open.exists():
            self.open.update((self.open.get()[0] + added,))
            return
        self.open.update((added,))
        self.handle.registerTimer(now + self.hold if self.hold else now - 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            cs = self.open.get()[0]
            self.open.clear()
            self.closed.update((timerValues.getCurrentProcessingTimeInMs(),))
            yield self._row(key, cs, "closed")

    def close(self) -> None:
        pass


def stream_media_minutes(
    lines: DataFrame, path: str, checkpoint: str, hold: float = 300.0, ttl: float = 86400.0, interval: str | None = None
) -> StreamingQuery:
    """Published bytes per domain and minute, as rows of (domain, timestamp, cs, kind) in the one table ``path``.

    With ``hold=0`` a minute is closed by the batch that brings its first lines.
    """
    spark = lines.sparkSession
    media = publish_only(parse_media_log(lines, only="publish")).select("domain", F.col("timestamp").cast("bigint").alias("timestamp"), "cs")
    # These settings are the query's own: the session's are put back once it has begun. Timers ask for batches
    # without data for ever, so a query that is to stop with the data at hand runs none.
    own = {STORE: ROCKSDB} | ({} if interval else {IDLE_BATCHES: "false"})
    before = {key: spark.conf.get(key) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        minutes = media.groupBy("domain", "timestamp").transformWithStateInPandas(
            statefulProcessor=MinuteSums(hold, ttl), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime")
        writer = minutes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def minute_sums(rows: DataFrame) -> DataFrame:
    """Closed minutes and their corrections -> one row per domain and minute."""
    return rows.groupBy("domain", "timestamp").agg(F.sum("cs").alias("cs"))
