"""Address and URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import TO_END, as_column, split_trimmed, strict_int


def ip_to_long(ip: Column | str) -> Column:
    """Dotted text -> bigint, base 256 from the right; -1 when a field is not a number.

    Fields are not held to 0-255 and any number of fields is accepted.
    """
    start = F.lit(0).cast("bigint")
    total = F.aggregate(
        split_trimmed(ip, "."), start, lambda sofar, field: sofar * 256 + strict_int(field).cast("bigint")
    )
    return F.coalesce(total, F.lit(-1).cast("bigint"))


URL_PARTS = ("domain", "dir1", "dir2")


def url_path(url: Column | str) -> Column:
    """Host and path segments of an ``http://`` URL as an array; query text stays in its segment."""
    return split_trimmed(as_column(url).substr(8, TO_END), "/")


def url_parts(url: Column | str) -> dict[str, Column]:
    """Host and first two path segments; null where the URL has no such segment."""
    parts = url_path(url)
    return {name: F.get(parts, F.lit(at)) for at, name in enumerate(URL_PARTS)}
