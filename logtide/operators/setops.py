"""Bag union and set difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_streams(sources: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name, for tables and streams alike."""
    return reduce(DataFrame.unionByName, sources)


def set_difference(requested: DataFrame, found: DataFrame) -> DataFrame:
    """Distinct rows of the first side that the second does not hold."""
    return requested.subtract(found)
