"""Dimension rows with a time: which version of a key held when.

A version of a key holds from its ``valid_from`` on, until the key's next version begins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key's stretch of time with more than this part of the facts is dealt over several tasks.
SHARE = 1 / 16384


def _stretch(at: Column, width: float) -> Column:
    return F.floor(at.cast("double") / F.lit(float(width)))


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    valid_from: str = "valid_from",
    values: Sequence[str] | None = None,
    how: str = "left",
    width: float = 3600.0,
) -> DataFrame:
    """Add to each fact the ``values`` of the version that holds at its time.

    A version that begins at the fact's own time holds. Of versions with one key and beginning the greatest one
    (by ``values`` in order) decides; versions without a key or beginning hold nothing. A
    fact without a version, a key or a time keeps its row with nulls (``how='left'``) or is dropped (``'inner'``).
    ``values`` are all other columns of ``versions`` by default; a name that the facts have too is an error.
    ``at`` is a timestamp or a number of seconds, and ``valid_from`` is cast to its type.

    Time is cut into stretches of ``width`` seconds. Facts and versions of a key and stretch are shuffled together and
    sorted once, and a running ``last`` finds each fact's version; the version that holds when a
    stretch begins is carried into it from the earlier ones. So a key's history is spread
    over its stretches, and no fact meets more than one version. A stretch with more than SHARE of the facts is
    dealt over several tasks, each with the stretch's versions; there are fewer than 1 / SHARE such stretches, so
    they are broadcast. The facts' keys and times are read once more to count them: write costly facts through first.
    """
    values = list(values or [c for c in versions.columns if c not in (*on, valid_from)])
    clash = sorted(set(values) & set(facts.columns))
    if clash:
        raise ValueError(f"facts and versions share the columns {clash}")
    keys = [f"_key{i}" for i in range(len(on))]
    cell = [*keys, "_stretch"]
    kind = facts.schema[at].dataType

    rows = facts.select(
        F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)], F.col(f"`{at}`").alias("_at"))
    rows = rows.withColumn("_stretch", _stretch(F.col("_at"), width))
    held = versions.select(
        *[F.col(f"`{c}`").cast(facts.schema[c].dataType).alias(k) for c, k in zip(on, keys)],
        F.col(f"`{valid_from}`").cast(kind).alias("_at"),
        F.struct(*[F.col(f"`{c}`") for c in values]).alias("_version"))
    held = held.dropna(subset=[*keys, "_at"]).groupBy(*keys, "_at").agg(F.max("_version").alias("_version"))
    held = held.withColumn("_stretch", _stretch(F.col("_at"), width))

    counts = rows.dropna(subset=[*keys, "_at"]).groupBy(*cell).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    slots = F.greatest(F.ceil(F.col("_n") / (total * F.lit(SHARE))), F.lit(1)).cast("int")
    cells = counts.select(*cell, slots.alias("_slots"))
    crowded = cells.where("_slots > 1")

    # The last version of each stretch, seen by the key's later stretches: one row per key and stretch.
    ends = held.groupBy(*cell).agg(F.max_by("_version", "_at").alias("_end"))
    marks = cells.unionByName(ends, allowMissingColumns=True)
    marks = marks.groupBy(*cell).agg(F.max("_slots").alias("_slots"), F.first("_end", ignorenulls=True).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("_version", F.last("_end", ignorenulls=True).over(earlier)).where(F.col("_slots").isNotNull())
    each_slot = F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)).alias("_slot")
    carried = marks.where(F.col("_version").isNotNull()).select(*cell, each_slot, F.lit(0).alias("_kind"), "_version")
    begun = held.join(cells, cell).select(*cell, each_slot, F.lit(1).alias("_kind"), "_at", "_version")

    # Facts by their place as well, so that equal facts of a crowded stretch are dealt out; those without a key or time anywhere.
    place = F.xxhash64(F.monotonically_increasing_id())
    lost = F.greatest(*[F.col(c).isNull() for c in (*keys, "_at")], F.lit(False))
    width_of = F.when(lost, F.lit(int(1 / SHARE))).otherwise(F.coalesce("_slots", F.lit(1)))
    dealt = rows.withColumn("_place", place).join(F.broadcast(crowded), cell, "left")
    dealt = dealt.select(*cell, F.pmod("_place", width_of).cast("int").alias("_slot"), F.lit(2).alias("_kind"), "_at", "_fact")

    merged = dealt.unionByName(begun, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    order = Window.partitionBy(*cell, "_slot").orderBy(F.col("_at").asc_nulls_first(), "_kind")
    latest = F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = merged.withColumn("_latest", latest).where(F.col("_kind") == 2)
    if how == "inner":
        found = found.where(F.col("_latest").isNotNull())
    return found.select("_fact.*", *[F.col(f"_latest.`{c}`").alias(c) for c in values])


def state_at(versions: DataFrame, on: Sequence[str], moment: Column, valid_from: str = "valid_from", held: str = "held") -> DataFrame:
    """The dimension as it was at ``moment``: each key's last version by then, without keys that had gone (``held`` is false)."""
    others = [c for c in versions.columns if c not in on]
    last = versions.where(F.col(valid_from) <= moment).groupBy(*on).agg(F.max_by(F.struct(*others), F.col(valid_from)).alias("_last"))
    return last.where(F.col(f"_last.{held}")).select(*on, *[F.col(f"_last.`{c}`").alias(c) for c in others if c not in (held, valid_from)])


def changes(before: DataFrame, now: DataFrame, on: Sequence[str], moment: Column) -> DataFrame:
    """What differs between two states, as versions that begin at ``moment``; keys that have gone are not ``held``.

    Both states have one row per key. The columns are those of ``now``, then ``valid_from`` and ``held``.
    """
    values = [c for c in now.columns if c not in on]
    renamed = before.select(*[F.col(f"`{c}`").alias(f"_was_{c}") for c in (*on, *values)], F.lit(True).alias("_was"))
    same_key = F.lit(True)
    for c in on:
        same_key = same_key & (F.col(c) == F.col(f"_was_{c}"))
    both = now.withColumn("_is", F.lit(True)).join(renamed, same_key, "full")
    same = F.col("_is").isNotNull() & F.col("_was").isNotNull()
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"_was_{c}"))
    keys = [F.coalesce(F.col(c), F.col(f"_was_{c}")).alias(c) for c in on]
    ordered = {c: k for c, k in zip(on, keys)}
    return both.where(~same).select(
        *[ordered.get(c, F.col(f"`{c}`")) for c in now.columns],
        moment.alias("valid_from"), F.col("_is").isNotNull().alias("held"))
