"""Dimension joins: equality joins whose strategy the planner picks by size.

A dimension read from files is sized by its files, a computed one by its shuffle when it
has run: below ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast, beyond it both
sides are shuffled, and adaptive execution cuts the partition of a hot key into slices
(facts stand on the left, the side that may be cut in every join type used here).
Nothing is counted first and nothing runs while a join is being built. ``salted_join``
spreads keys up front, for joins that adaptive execution does not reach.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 8


def _matched(
    facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str, residual: Column | None
) -> DataFrame:
    renamed = {name: f"_dim_{name}" for name in on}
    side = dim.withColumnsRenamed(renamed)
    condition = F.lit(True)
    for name, other in renamed.items():
        condition = condition & (F.col(name) == F.col(other))
    if residual is not None:
        condition = condition & residual
    return facts.join(side, condition, how).drop(*renamed.values())


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    residual: Column | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join in which each key's facts are spread over ``salts`` tasks.

    The salt is a hash of the fact row and of its number in its partition, so rows that are
    equal are spread too; ``dim`` is repeated once per salt, so any salt finds its match.
    """
    own = F.xxhash64(*_hashable(facts), F.monotonically_increasing_id())
    salted = facts.withColumn("_salt", F.pmod(own, F.lit(salts)).cast("int"))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return _matched(salted, repeated, [*on, "_salt"], how, residual).drop("_salt")


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    residual: Column | None = None,
) -> DataFrame:
    """Join facts to a dimension.

    ``how`` is inner, left, left_semi or left_anti; ``residual`` is a further
    condition over column names that the two sides do not share.
    """
    return _matched(facts, dim, on, how, residual)


def channel_users(channels: DataFrame, domain: str = "domain", userid: str = "userid") -> DataFrame:
    """One userid per domain (the smallest), so that a lookup never adds rows."""
    return channels.groupBy(F.col(domain).alias("domain")).agg(F.min(userid).alias("userid"))


def attach_userid(media: DataFrame, channels: DataFrame) -> DataFrame:
    """Add the userid of each row's domain; an unknown domain keeps its row with a null userid."""
    return lookup_join(media, channel_users(channels), ["domain"], "left")


def domain_semi_join(df: DataFrame, domains: DataFrame) -> DataFrame:
    """Rows of the listed domains."""
    return lookup_join(df, domains.select("domain").distinct(), ["domain"], "left_semi")


def domain_anti_join(df: DataFrame, domains: DataFrame) -> DataFrame:
    """Rows of all other domains."""
    return lookup_join(df, domains.select("domain").distinct(), ["domain"], "left_anti")


def term_lookup(terms: DataFrame, vocabulary: DataFrame, on: str = "term") -> DataFrame:
    """Add term ids and weights; terms outside the vocabulary are dropped.

    A vocabulary grows with the data; it is broadcast only while the planner finds it small.
    """
    return lookup_join(terms, vocabulary, [on], "inner")
