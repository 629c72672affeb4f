"""Time expressions. Epoch seconds are bigint; text forms are read and printed in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column, strict_long

LOG_TIME = "d/MMM/yyyy:H:m:s"
LOG_TIME_WITH_ZONE = "d/MMM/yyyy:H:m:s Z"

# Log times look like 02/Jan/2024:03:04:05, with or without a zone after them.
LOG_TIME_SHAPE = r"[0-9]{1,2}/[A-Za-z]{3}/[0-9]{4}:[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"


def floor_to(seconds: Column | str, width: int) -> Column:
    """The start of the ``width``-second bucket, cut toward zero."""
    return F.call_function("div", as_column(seconds), F.lit(width)) * F.lit(width)


def _floor_text(seconds: Column | str, width: int) -> Column:
    text = as_column(seconds)
    return F.coalesce(floor_to(strict_long(text), width).cast("string"), text)


def minute_floor(seconds: Column | str) -> Column:
    """Text seconds -> text seconds of the minute start; other text is returned as it is."""
    return _floor_text(seconds, 60)


def hour_floor(seconds: Column | str) -> Column:
    """Text seconds -> text seconds of the hour start; other text is returned as it is."""
    return _floor_text(seconds, 3600)


def five_minute_mark(seconds: Column | str) -> Column:
    """The next 5-minute mark; an exact mark moves to the following one."""
    return floor_to(seconds, 300) + F.lit(300)


def epoch_to_text(seconds: Column | str, pattern: str) -> Column:
    return F.date_format(F.timestamp_seconds(as_column(seconds)), pattern)


def text_to_time(text: Column | str, pattern: str) -> Column:
    """Text -> timestamp by pattern; null when the text does not fit."""
    return F.try_to_timestamp(as_column(text), F.lit(pattern))


def plus_days(text: Column | str, pattern: str, days: int | Column = 1) -> Column:
    """Shift a day held as text, keeping its pattern."""
    step = days if isinstance(days, Column) else F.lit(days)
    return F.date_format(text_to_time(text, pattern) + F.make_dt_interval(days=step), pattern)


def day_range(start: Column | str, end: Column | str, pattern: str, step: int = 1) -> Column:
    """Array of day texts from start to end inclusive; empty when start is after end."""
    first = text_to_time(start, pattern).cast("date")
    last = text_to_time(end, pattern).cast("date")
    days = F.sequence(first, last, F.make_dt_interval(days=F.lit(step)))
    texts = F.transform(days, lambda day: F.date_format(day, pattern))
    return F.when(first <= last, texts).otherwise(F.array().cast("array<string>"))


def batch_time_parts(moment: Column | str) -> dict[str, Column]:
    """Table partition values and index names for a batch time."""
    at = as_column(moment)
    return {
        "month_": F.date_format(at, "yyyyMM"),
        "day_": F.date_format(at, "dd"),
        "hour_": F.date_format(at, "HH"),
        "day_index": F.date_format(at, "yyyyMMdd"),
        "hour_index": F.date_format(at, "yyyyMMddHH"),
    }


def _bracketed_time(line: Column | str, shape: str) -> Column:
    """What has the given shape right after the first ``[``; null when a ``]`` is missing or comes first."""
    found = F.regexp_extract(as_column(line), rf"^[^\[\]]*\[({shape})[^\]]*\]", 1)
    return F.nullif(found, F.lit(""))


def log_seconds(line: Column | str) -> Column:
    """Epoch seconds of a log line's bracketed local time; a zone after it is not read."""
    return F.unix_timestamp(text_to_time(_bracketed_time(line, LOG_TIME_SHAPE), LOG_TIME))


def log_hour(line: Column | str) -> Column:
    """``yyyy/MM/dd/HH`` of a log line's bracketed time, with its zone taken into account."""
    moment = _bracketed_time(line, f"{LOG_TIME_SHAPE} [+-][0-9]{{4}}")
    return F.date_format(text_to_time(moment, LOG_TIME_WITH_ZONE), "yyyy/MM/dd/HH")
