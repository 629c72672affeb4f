"""A dimension that remembers what it held when, for batches that are run again."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lookups import attach_userid
from ..operators.versions import changes, state_at
from ..session import remove_folder
from ..sinks.tables import write_batch
from .batches import batch_function_sink, batch_moment
from .jobs import media_traffic_batch

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _micros(moment: datetime) -> int:
    at = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return (at - _EPOCH) // timedelta(microseconds=1)


class VersionedDimension:
    """Versions of a dimension in a folder: what changed at each reading, by the time of the reading.

    ``load`` gives the dimension now; of several rows of a key the greatest counts, and rows lacking a key none. ``refresh``
    reads it when the last reading is older than ``ttl`` seconds and writes the rows that changed, and
    keys that have gone, as versions from that moment on. ``rows(moment)`` is the dimension as it was then, so a
    batch that is run again under its first time meets the rows it met at first, also after a restart of the driver:
    all that is known is in the folder. ``forget`` folds versions that ended before a moment.

    One folder a reading, ``change-<microseconds>``; ``base-<microseconds>`` holds all versions up to a reading and takes the
    place of earlier folders. A folder counts once Spark has marked it as whole, so a reading that broke off
    leaves nothing behind that is read. One driver writes.
    """

    def __init__(self, spark: SparkSession, path: str, load: Callable[[], DataFrame], keys: Sequence[str], ttl: float = 3600.0) -> None:
        self._spark, self._path, self._load, self._keys, self._ttl = spark, path.rstrip("/"), load, list(keys), ttl

    def _folders(self) -> list[tuple[int, str]]:
        """Whole folders in the order of their moments, a base after the change of its moment: one name per reading kept."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        fs = path.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        whole = [n for n in names if fs.exists(self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{n}/_SUCCESS"))]
        return sorted(((int(n.split("-")[1]), n) for n in whole), key=lambda f: (f[0], f[1].startswith("base")))

    def _in_use(self) -> list[str]:
        names = [name for _, name in self._folders()]
        bases = [i for i, name in enumerate(names) if name.startswith("base")]
        return names[bases[-1]:] if bases else names

    def versions(self) -> DataFrame | None:
        """All versions that are kept, with ``valid_from`` and ``held``; None before the first reading."""
        names = self._in_use()
        return self._spark.read.parquet(*[f"{self._path}/{name}" for name in names]) if names else None

    def refresh(self, moment: datetime) -> bool:
        """Read the dimension if the last reading is older than ``ttl`` at ``moment``; tell whether it was read."""
        folders = self._folders()
        if folders and _micros(moment) - folders[-1][0] <= self._ttl * 1e6:
            return False
        loaded = self._load()
        names = loaded.columns
        others = [c for c in names if c not in self._keys]
        now = loaded.dropna(subset=self._keys).groupBy(*self._keys).agg(F.max(F.struct(*others)).alias("_v"))
        now = now.select(*[c if c in self._keys else F.col(f"_v.`{c}`").alias(c) for c in names])
        at = F.timestamp_micros(F.lit(_micros(moment)))
        known = self.versions()
        found = changes(state_at(known, self._keys, at), now, self._keys, at) if known is not None else now.select(
            "*", at.alias("valid_from"), F.lit(True).alias("held"))
        found.write.mode("overwrite").parquet(f"{self._path}/change-{_micros(moment):020d}")
        return True

    def rows(self, moment: datetime) -> DataFrame:
        """The dimension as it was at ``moment``."""
        known = self.versions()
        if known is None:
            raise ValueError("the dimension has not been read yet")
        return state_at(known, self._keys, F.timestamp_micros(F.lit(_micros(moment))))

    def forget(self, before: datetime) -> None:
        """Drop versions that ended before a moment, and keys gone by then; later states stay as they were.

        The new base is whole before the folders that it replaces are removed. Call it between batches.
        """
        folders, known = self._folders(), self.versions()
        if known is None or folders[-1][1].startswith("base"):
            return
        at = F.timestamp_micros(F.lit(_micros(before)))
        # The last beginning by then is written per key; versions at or after it stay, unless it only says that the key has gone.
        last = known.where(F.col("valid_from") <= at).groupBy(*self._keys).agg(F.max("valid_from").alias("_last"))
        kept = known.join(last, self._keys, "left").where(
            F.col("_last").isNull() | (F.col("valid_from") > F.col("_last")) | ((F.col("valid_from") == F.col("_last")) & F.col("held")))
        kept.select(*known.columns).write.mode("overwrite").parquet(f"{self._path}/base-{folders[-1][0]:020d}")
        for _, name in folders:
            remove_folder(self._spark, f"{self._path}/{name}")


def stream_media_as_of(
    lines: DataFrame,
    channels: VersionedDimension,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """As ``stream_media_traffic``, with the userids that held at the batch's time, also when the batch is run again."""

    def action(batch: DataFrame, batch_id: int) -> None:
        moment = batch_moment(batch.sparkSession, checkpoint, batch_id, clock)
        channels.refresh(moment)
        named = attach_userid(media_traffic_batch(batch), channels.rows(moment))
        write_batch(named.select("domain", "timestamp", "userid", "cs"), path, batch_id)

    return batch_function_sink(lines, action, checkpoint, "append", interval)
