"""Running a streaming query with a function per batch."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import new_folder, remove_folder, write_through
from ..sinks.tables import write_batch


def batch_function_sink(
    stream: DataFrame,
    action: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    interval: str | None = None,
) -> StreamingQuery:
    """Start ``action(batch, batch_id)`` on every micro-batch.

    Without ``interval``, the query takes what is there and stops. A batch may
    be run again after a failure, under the same id.
    """
    writer = stream.writeStream.foreachBatch(action).outputMode(output_mode)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def batch_moment(spark: SparkSession, checkpoint: str, batch_id: int, clock: Callable[[], float] = time.time) -> datetime:
    """The time of a batch: taken when it is first asked for, and kept under ``checkpoint`` for later tries."""
    path = f"{checkpoint}-times/batch_id={batch_id}"
    try:
        return spark.read.schema("moment timestamp").parquet(path).first().moment
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    moment = datetime.fromtimestamp(int(clock()), timezone.utc)
    spark.createDataFrame([(moment,)], "moment timestamp").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first().moment


def batch_table_sink(path: str) -> Callable[[DataFrame, int], None]:
    """An action that keeps each batch under its id, so that a replay replaces it."""

    def action(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return action


class RefreshingDimension:
    """A dimension that is read again once it is older than ``ttl`` seconds.

    Used inside a batch function: every batch asks for the current rows. What is loaded is
    written once to a folder of its own and served from there, so replacing the source in
    the meantime disturbs no batch, and batches share one reading of it. A copy is removed when
    the second one after it is loaded: no batch that began with it is still running then.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        ttl: float = 3600.0,
        clock: Callable[[], float] = time.time,
    ) -> None:
        self._load = load
        self._ttl = ttl
        self._clock = clock
        self._rows: DataFrame | None = None
        self._read_at = 0.0
        self._folders: list[str] = []

    def rows(self) -> DataFrame:
        now = self._clock()
        if self._rows is None or now - self._read_at > self._ttl:
            rows = self._load()
            spark = rows.sparkSession
            self._folders.append(new_folder(spark, "dimension"))
            self._rows = write_through(rows, folder=self._folders[-1])
            self._read_at = now
            while len(self._folders) > 2:
                remove_folder(spark, self._folders.pop(0))
        return self._rows
