"""Buckets of equal size along an order, without numbering all rows.

A bucket begins at a rank that follows from the number of rows alone. The row at such a rank is found by
selection: approximate quantiles enclose it in a narrow range of values, one aggregate counts the rows
below the range, and only the rows inside are put in order, by value and then by key. The rows' buckets
follow from comparing them with these few edge rows, so no window or join touches them, and any number
of orders over one frame are cut together.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.operators.ordering import with_row_number

#: All orders are compared in this type.
VALUE = "decimal(38,6)"
#: Stands before all values of an order, for rows that have none.
BEFORE_ALL, AFTER_ALL = Decimal(-(10 ** 30)), Decimal(10 ** 30)
ACCURACY = 10_000

Starts = Callable[[int], dict[int, int]]


def ntile_starts(tiles: int) -> Starts:
    """The rank at which each NTILE bucket from the second on begins."""
    def starts(n: int) -> dict[int, int]:
        size, larger = divmod(n, tiles)
        ranks = {b: (b - 1) * size + min(b - 1, larger) + 1 for b in range(2, tiles + 1)}
        return {b: rank for b, rank in ranks.items() if rank <= n}
    return starts


def edge_rows(df: DataFrame, orders: dict[str, Column], key: str, starts: Starts,
              slices: int | None = None) -> dict[str, dict[int, tuple]]:
    """For each order the (value, key) of the row at which each bucket begins. Orders are numbers,
    ascending, ties by the key, which is unique; none of them is null."""
    n = df.count()
    ranks = starts(n)
    if not ranks:
        return {name: {} for name in orders}
    values = {name: F.coalesce(order.cast(VALUE), F.lit(BEFORE_ALL).cast(VALUE))
              for name, order in orders.items()}
    margin = 2 * n / ACCURACY + 1
    shares = [min(1.0, max(0.0, (rank + off) / n)) for rank in ranks.values()
              for off in (-margin, margin)]
    rough = df.agg(*[F.percentile_approx(v.cast("double"), shares, ACCURACY).alias(name)
                     for name, v in values.items()]).first()
    slots = [(name, bucket, rank, rough[name][2 * i], rough[name][2 * i + 1])
             for name in orders for i, (bucket, rank) in enumerate(ranks.items())]

    def counts(which: list) -> list[tuple[int, int]]:
        sums = df.agg(*[c for s, (name, _, _, low, high) in enumerate(which) for c in (
            F.count_if(values[name].cast("double") < F.lit(low)).alias(f"b{s}"),
            F.count_if(values[name].cast("double").between(F.lit(low), F.lit(high))).alias(f"i{s}"))]
                      ).first()
        return [(sums[f"b{s}"], sums[f"i{s}"]) for s in range(len(which))]

    found = counts(slots)
    # Where the sketch was off, the range is everything; the result doesn't depend on it.
    slots = [slot if below < slot[2] <= below + inside else (*slot[:3], float("-inf"), float("inf"))
             for slot, (below, inside) in zip(slots, found)]
    found = [(below, inside) if below < slot[2] <= below + inside else (0, n)
             for slot, (below, inside) in zip(slots, found)]
    inside = df.select(F.col(key).alias("_key"), F.explode(F.filter(F.array(*[
        F.when(values[name].cast("double").between(F.lit(low), F.lit(high)),
               F.struct(F.lit(s).alias("slot"), values[name].alias("value")))
        for s, (name, _, _, low, high) in enumerate(slots)]), lambda x: x.isNotNull())).alias("_in"))
    numbered = with_row_number(inside.select("_in.slot", "_in.value", "_key"),
                               [F.asc("slot"), F.asc("value"), F.asc("_key")], "_rn", slices=slices)
    wanted, before = {}, 0
    for s, (slot, (below, count)) in enumerate(zip(slots, found)):
        wanted[before + slot[2] - below] = s
        before += count
    edges: dict[str, dict[int, tuple]] = {name: {} for name in orders}
    for row in numbered.where(F.col("_rn").isin(*wanted)).collect():
        name, bucket = slots[wanted[row["_rn"]]][:2]
        edges[name][bucket] = row["value"], row["_key"]
    return edges


def with_buckets(df: DataFrame, orders: dict[str, Column], key: str, starts: Starts,
                 slices: int | None = None) -> DataFrame:
    """The rows with their bucket along each order. ``df`` is read several times: pin it before."""
    edges = edge_rows(df, orders, key, starts, slices)

    def bucket(name: str) -> Column:
        value = F.coalesce(orders[name].cast(VALUE), F.lit(BEFORE_ALL).cast(VALUE))
        reached = [(value > F.lit(v).cast(VALUE)) | ((value == F.lit(v).cast(VALUE)) & (F.col(key) >= F.lit(k)))
                   for v, k in edges[name].values()]
        return reduce(lambda total, x: total + F.when(x, 1).otherwise(0), reached, F.lit(1))

    return df.select("*", *[bucket(name).cast("int").alias(name) for name in orders])
