"""Address -> company by closed ranges, as a merge of both sides in address order.

Addresses and range starts are cut at the same bounds, quantiles of the addresses, and sorted
together, so that a running ``last`` finds the range that starts last at or before an
address. The last start of all earlier parts is carried into each part.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.net import ip_to_long

# Share of the events that the quantiles are taken from.
SAMPLED = 1 / 16


def _bounds(addresses: DataFrame, parts: int) -> tuple[list[int], list[int]]:
    """Ascending lower bounds of all parts but the first, and the slots of every part.

    A quantile that comes several times is a hot address: it becomes a part of its own, with
    one slot for each time. There are at most twice ``parts`` slots.
    """
    shares = [i / parts for i in range(1, parts)]
    quantiles = []
    if shares:
        accuracy = max(10_000, 50 * parts)
        quantiles = addresses.agg(F.percentile_approx("_ip_at", shares, accuracy)).first()[0] or []
    bounds, slots = [], [1]
    for at, times in sorted(Counter(quantiles).items()):
        if bounds and bounds[-1] == at:  # the bound behind a hot address one lower
            slots[-1] = times
        else:
            bounds.append(at)
            slots.append(times)
        if times > 1:
            bounds.append(at + 1)
            slots.append(1)
    return bounds, slots


def _part(address: Column, bounds: list[int]) -> Column:
    """The number of bounds at or below the address, by halving."""
    if not bounds:
        return F.lit(0)
    steps = F.lit([1 << i for i in reversed(range(len(bounds).bit_length()))])
    listed = F.lit(bounds).cast("array<bigint>")
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(listed, at + step - 1) <= address, at + step).otherwise(at))


def ip_to_company(
    events: DataFrame, ranges: DataFrame, ip: str = "ip", how: str = "left", parts: int | None = None
) -> DataFrame:
    """Add the company whose range holds the address, whatever its number of fields.

    Of the ranges that start at or before an address the one that starts last decides, as in a
    search of a sorted list: an address beyond its end has no company, even if an earlier range
    reaches farther. Of ranges with one start the one that ends last decides, then the
    greatest company. Ranges that end before they start, or lack a bound, hold nothing. An event
    is one row of the result; ``how='left'`` keeps those without a company (null), ``'inner'``
    drops them.

    Each side is shuffled once. ``parts`` (default: the session's shuffle width) is the number
    of address quantiles; a hot address takes as many tasks as it has quantiles. A first pass over a sixteenth of
    the addresses finds the quantiles, which are all that the driver sees; they spread the work and change no row.
    """
    spark = events.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    addressed = events.select(F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("_ip_event"), ip_to_long(ip).alias("_ip_at"))
    bounds, slots = _bounds(addressed.sample(SAMPLED, seed=7).select("_ip_at"), parts)
    first_slots = F.lit([0, *accumulate(slots)][:-1])
    width = F.lit(slots)

    def first_slot(part):
        return F.get(first_slots, part)

    def all_slots(part):
        return F.explode(F.sequence(first_slot(part), first_slot(part) + F.get(width, part) - 1))

    # One range per start; a struct compares field by field, so the one that ends last.
    reach = F.struct(F.col("end_ip").alias("to"), F.col("company").alias("company"))
    whole = ranges.where(F.col("start_ip") <= F.col("end_ip")).select(F.col("start_ip").cast("bigint").alias("_ip_at"), reach.alias("_ip_range"))
    part = _part(F.col("_ip_at"), bounds)
    starts = whole.groupBy("_ip_at").agg(F.max("_ip_range").alias("_ip_range")).withColumn("_ip_part", part)

    # The last start of each part, for all slots up to the next part with one: at most twice `parts` rows.
    lasts = whole.withColumn("_ip_part", part).groupBy("_ip_part").agg(F.max(F.struct("_ip_at", "_ip_range")).alias("_ip_last"))
    following = F.lead("_ip_part").over(Window.orderBy("_ip_part"))
    until = F.coalesce(first_slot(following) + F.get(width, following), F.lit(sum(slots))) - 1
    since = first_slot(F.col("_ip_part")) + F.get(width, F.col("_ip_part"))
    carried = lasts.select(F.col("_ip_last._ip_range").alias("_ip_range"), since.alias("_ip_since"), until.alias("_ip_until"))

    # Carried ranges come first in their slot, then by address, starts before the events at them.
    placed = addressed.withColumn("_ip_part", _part(F.col("_ip_at"), bounds))
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.get(width, F.col("_ip_part")).cast("bigint"))
    placed = placed.select("_ip_event", "_ip_at", F.lit(2).alias("_ip_kind"), (first_slot(F.col("_ip_part")) + dealt).cast("int").alias("_ip_slot"))
    own = starts.select("_ip_range", "_ip_at", F.lit(1).alias("_ip_kind"), all_slots(F.col("_ip_part")).alias("_ip_slot"))
    carried = carried.where(F.col("_ip_since") <= F.col("_ip_until")).select(
        "_ip_range", F.lit(None).cast("bigint").alias("_ip_at"), F.lit(0).alias("_ip_kind"),
        F.explode(F.sequence("_ip_since", "_ip_until")).alias("_ip_slot"))
    merged = placed.unionByName(own, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    order = Window.partitionBy("_ip_slot").orderBy(F.col("_ip_at").asc_nulls_first(), "_ip_kind")
    latest = F.last("_ip_range", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    named = merged.withColumn("_ip_latest", latest).where(F.col("_ip_kind") == 2)
    company = F.when(F.col("_ip_at") <= F.col("_ip_latest.to"), F.col("_ip_latest.company"))
    if how == "inner":
        named = named.where(company.isNotNull())
    return named.select("_ip_event.*", company.alias("company"))
