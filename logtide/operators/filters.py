"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_column

# 12 months of 30 days, in seconds.
EVENT_TIME_SPAN = 12 * 30 * 24 * 60 * 60

# Fixed values of the channel dimension.
LIVE_BUSINESS = "2"
EXPORT_CUSTOMER = "3038"


def drop_malformed(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Keep rows that have every required value."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return df.where(complete)


def publish_only(media: DataFrame) -> DataFrame:
    return media.where(F.col("flag") == "publish")


def tag_contains(lines: DataFrame, tag: str, line: str = "line") -> DataFrame:
    return lines.where(F.col(line).contains(tag))


def http_get_only(url: Column | str | None = None, line: Column | str | None = None) -> Column:
    """Condition: an ``http://`` URL and / or a GET request line."""
    condition = F.lit(True)
    if url is not None:
        condition = condition & as_column(url).startswith("http://")
    if line is not None:
        condition = condition & as_column(line).contains("GET ")
    return condition


def usable_offset_ranges(manifest: DataFrame, white_topics: Sequence[str]) -> DataFrame:
    """Ranges of white-listed topics that hold at least one offset."""
    return manifest.where(
        F.col("topic").isin(list(white_topics)) & (F.col("start_offset") < F.col("end_offset"))
    )


def event_time_guard(bucket: Column | str, start: int, span: int = EVENT_TIME_SPAN) -> Column:
    """Condition: the (bucketed) time lies within ``span`` seconds of ``start``."""
    return F.abs(as_column(bucket) - F.lit(start).cast("bigint")) < F.lit(span)


def _domains(channels: DataFrame, line: str, position: int, value: str) -> DataFrame:
    cells = channels.select(F.split(F.col(line), ",").alias("_c"))
    chosen = cells.where(F.get("_c", F.lit(position)) == value)
    return chosen.select(F.get("_c", F.lit(0)).alias("domain")).distinct()


def live_domains(channels: DataFrame, line: str = "line") -> DataFrame:
    """Distinct domains whose business type (column 10) is live."""
    return _domains(channels, line, 10, LIVE_BUSINESS)


def export_domains(channels: DataFrame, line: str = "line", customer: str = EXPORT_CUSTOMER) -> DataFrame:
    """Distinct domains whose customer code (column 6) is the export customer."""
    return _domains(channels, line, 6, customer)
