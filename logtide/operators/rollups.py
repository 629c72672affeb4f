"""Traffic roll-ups and other plain aggregations (partial sums before every shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strict_long
from ..functions.times import five_minute_mark
from .filters import event_time_guard, publish_only
from .lookups import attach_userid


def media_traffic_minute(media: DataFrame, channels: DataFrame) -> DataFrame:
    """Published bytes by (domain, userid, minute).

    A domain has one userid, so bytes are summed by domain and minute first and
    the userid is attached to the sums: the join sees few rows and no hot key.
    """
    sums = publish_only(media).groupBy("domain", "timestamp").agg(F.sum("cs").alias("cs"))
    return attach_userid(sums, channels).select("domain", "userid", "timestamp", "cs")


def dir_traffic_minute(access: DataFrame) -> DataFrame:
    """Bytes by (domain, dir1, dir2, minute)."""
    return access.groupBy("domain", "dir1", "dir2", "timestamp").agg(F.sum("cs").alias("cs"))


def pno_traffic_5min(minutes: DataFrame, start: int, write_time: str) -> DataFrame:
    """Minute counters -> bytes by (domain, pno, 5-minute mark), stamped with ``write_time``.

    ``timestamp`` and ``cs`` come as text, ``start`` is the run's start in
    seconds; marks 360 days or more away from it are dropped.
    """
    marked = minutes.select(
        "domain",
        "pno",
        five_minute_mark(strict_long(F.col("timestamp").cast("string"))).alias("_mark"),
        strict_long(F.col("cs").cast("string")).alias("cs"),
    ).where(event_time_guard("_mark", start))
    sums = marked.groupBy("domain", "pno", "_mark").agg(F.sum("cs").alias("cs"))
    return sums.select(
        "domain",
        "pno",
        F.col("_mark").cast("string").alias("timestamp"),
        F.lit(write_time).alias("write_time"),
        "cs",
    )


def distinct_ids(ratings: DataFrame, column: str) -> DataFrame:
    return ratings.select(column).distinct()


def batch_counts(messages: DataFrame) -> DataFrame:
    """Records and offset range ``[from, until)`` per topic and partition."""
    return messages.groupBy("topic", "partition_id").agg(
        F.count("*").alias("records"),
        F.min("msg_offset").alias("from_offset"),
        (F.max("msg_offset") + 1).alias("until_offset"),
    )


def mean_squared_error(
    pairs: DataFrame, actual: str = "rate", predicted: str = "pred", weight: str | None = None
) -> DataFrame:
    """Mean of (actual - predicted)^2 over all pairs, each counted ``weight`` times."""
    squared = F.pow(F.col(actual) - F.col(predicted), F.lit(2))
    if weight is None:
        return pairs.agg(F.count("*").alias("pairs"), F.avg(squared).alias("mse"))
    return pairs.agg(
        F.sum(weight).alias("pairs"),
        F.try_divide(F.sum(squared * F.col(weight)), F.sum(weight)).alias("mse"),
    )
