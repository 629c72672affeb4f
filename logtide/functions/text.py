"""Text expressions: strict numbers, splitting, archive and export names."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


# A length no text reaches: substr() up to the end.
TO_END = 2147483647


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def strict_long(value: Column | str) -> Column:
    """Optional sign and digits only, as bigint; anything else is null.

    A plain ``try_cast`` would also accept surrounding blanks (' 12 ').
    """
    text = as_column(value)
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def strict_int(value: Column | str) -> Column:
    """As :func:`strict_long`, limited to 32 bits."""
    text = as_column(value)
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


# What a pattern's $ passes over at the end of a text.
LINE_ENDS = ["", "\n", "\r\n", "\r", "\u0085", "\u2028", "\u2029"]


def trim_end(value: Column | str, delimiter: str) -> Column:
    """A text without the delimiters at its end; only a text that has some is searched."""
    text = as_column(value)
    ends = reduce(or_, (text.endswith(delimiter + end) for end in LINE_ENDS))
    return F.when(ends, F.regexp_replace(text, f"(?:{re.escape(delimiter)})+$", "")).otherwise(text)


def split_trimmed(value: Column | str, delimiter: str) -> Column:
    """Split on a literal, without the empty pieces at the end.

    ``a/b//`` gives ``[a, b]``, ``//`` gives no piece at all, and the empty
    text gives one empty piece.
    """
    text = as_column(value)
    literal = re.escape(delimiter)
    shortened = trim_end(text, delimiter)
    pieces = F.split(shortened, literal)
    return F.when((shortened == "") & (text != ""), F.array().cast("array<string>")).otherwise(pieces)


def split_cells(value: Column | str, delimiter: str = ",") -> Column:
    """Split on a literal and keep empty cells, also at the end of the line."""
    return F.split(as_column(value), re.escape(delimiter), -1)


def text_after(value: Column | str, mark: str, skip: int = 0) -> Column:
    """What follows the first ``mark``, less ``skip`` characters; null without the mark."""
    text = as_column(value)
    at = F.instr(text, F.lit(mark))
    return F.when(at > 0, text.substr(at + F.lit(len(mark) + skip), F.lit(TO_END)))


def archive_key(hour: Column | str) -> Column:
    """``yyyy/MM/dd/HH`` -> ``yyyy/MM/dd/HH_yyyy-MM-dd-HH``."""
    text = as_column(hour)
    return F.concat(text, F.lit("_"), F.replace(text, F.lit("/"), F.lit("-")))


def export_path(source: Column | str) -> Column:
    """``<domain>/<yyyy>/<MM>/<dd>/.../<hour>`` -> ``/<domain>/<day>/<day>_<hour>``."""
    parts = F.split(as_column(source), "/")
    day = F.concat_ws("-", F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3)))
    return F.when(
        F.size(parts) >= 5,
        F.concat(
            F.lit("/"), F.get(parts, F.lit(0)),
            F.lit("/"), day,
            F.lit("/"), day, F.lit("_"), F.element_at(parts, -1),
        ),
    )
