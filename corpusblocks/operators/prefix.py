"""Exclusive prefix aggregates over a total order, without a global sort.

A running sum over one unpartitioned window would pull a whole split into one
task. Here the order key is cut into a tree of buckets: the finest level windows
rows inside a bucket, each coarser level windows the totals of the buckets below
it, and the results are added on the way down. With the bucket widths of
``dense_levels`` no window ever sees more than ``FANOUT`` distinct keys, whatever
the distribution of keys or groups.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusblocks.functions.seeded import KEY_BITS

FANOUT_BITS = 12
FANOUT = 1 << FANOUT_BITS


@dataclass(frozen=True)
class Order:
    """A total order inside each group.

    ``levels`` are bucket expressions from fine to coarse, each a monotone
    function of the sort columns and of the level before it.
    """

    group: tuple[str, ...]
    sort: tuple[str, ...]
    levels: tuple[Column, ...]


def dense_levels(df: DataFrame, key: str, first_bits: int = FANOUT_BITS) -> tuple[Column, ...]:
    """Bucket levels for an integer key, from its range (one column is scanned).

    The finest bucket spans ``2**first_bits`` key values however they are
    distributed, so a crowded key range cannot make a large bucket.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    shift, levels = first_bits, []
    while True:
        levels.append(F.shiftright(F.col(key), shift))
        if low is None or (high >> shift) - (low >> shift) < FANOUT:
            return tuple(levels)
        shift += FANOUT_BITS


def hashed_levels(key: str, rows: int) -> tuple[Column, ...]:
    """Bucket levels for a uniform hash key of ``KEY_BITS`` bits over ``rows`` rows."""
    bucket_bits = max(0, rows.bit_length() - FANOUT_BITS)
    levels = []
    while True:
        levels.append(F.shiftright(F.col(key), KEY_BITS - bucket_bits))
        if bucket_bits <= FANOUT_BITS:
            return tuple(levels)
        bucket_bits -= FANOUT_BITS


_TOTAL = {"sum": F.sum, "min": F.min}


def _combine(agg: str, parts: list[Column]) -> Column:
    if agg == "sum":
        return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])
    return F.least(*parts)


def exclusive_prefix(df: DataFrame, order: Order, value: Column, out: str, agg: str = "sum") -> DataFrame:
    """Add ``out``: the aggregate of ``value`` over all earlier rows of the group.

    ``agg`` is ``sum`` (0 for the first row) or ``min`` (NULL for the first row).
    """
    total = _TOTAL[agg]
    group = list(order.group)
    names = [f"_level{i}" for i in range(len(order.levels))]
    rows = df.select("*", value.alias("_value"))
    for name, level in zip(names, order.levels):
        rows = rows.withColumn(name, level)

    def before(keys: list[str], by) -> W:
        return W.partitionBy(*keys).orderBy(*by).rowsBetween(W.unboundedPreceding, -1)

    # Totals per bucket, from fine to coarse: each level is summed from the one below.
    totals = [rows.groupBy(*group, *names).agg(total("_value").alias("_total"))]
    for i in range(1, len(names)):
        totals.append(totals[-1].groupBy(*group, *names[i:]).agg(total("_total").alias("_total")))

    # What precedes each bucket, from coarse to fine; windows see totals of one parent only.
    base: DataFrame | None = None
    for i in reversed(range(len(names))):
        parent = names[i + 1:i + 2]
        level = totals[i].withColumn("_before", total("_total").over(before(group + parent, [names[i]])))
        if base is not None:
            level = level.join(base, group + parent)
            level = level.withColumn("_before", _combine(agg, [F.col("_before"), F.col("_base")]))
        base = level.select(*group, names[i], F.col("_before").alias("_base"))

    fine = group + names[:1]
    local = rows.withColumn("_local", total("_value").over(before(fine, order.sort)))
    result = _combine(agg, [F.col("_local"), F.col("_base")])
    return local.join(base, fine).select(*df.columns, result.alias(out))
