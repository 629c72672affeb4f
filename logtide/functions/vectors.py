"""Expressions over array<double> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column


def as_doubles(vector: Column | str) -> Column:
    return as_column(vector).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column | str) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """dot(a, b) / (|a| |b|); null when either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(vector: Column | str) -> Column:
    """The vector scaled to length one; null for a zero vector."""
    length = norm(vector)
    return F.when(length > 0, F.transform(as_doubles(vector), lambda x: x / length))
