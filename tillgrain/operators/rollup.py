"""Sums of the order fact, taken before any join.

Grouping the fact on a dimension's key first lets every task combine its own rows, so a key that
holds a third of the orders costs one row per task in the shuffle, and what follows joins frames
with one row per key. No dimension is hinted for broadcast: the planner does that by itself while a
side stays below spark.sql.autoBroadcastJoinThreshold, and shuffles beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.functions.ratios import counts_as_revenue


# One type per sum, whether it was taken in one step or two.
SUMS = {"revenue": "decimal(24,2)", "profit": "decimal(24,2)", "discounts": "decimal(25,4)"}


def measures(*names: str) -> list[Column]:
    """Named sums over order rows. order_id is the fact's key, so counting rows counts orders."""
    known = {
        "revenue": F.sum("revenue"),
        "profit": F.sum("profit"),
        "units": F.sum("quantity"),
        "orders": F.count(F.lit(1)),
        "first_purchase": F.min("order_date"),
        "last_purchase": F.max("order_date"),
        "buyers": F.count_distinct("customer_id"),
        "discounts": F.sum("discount").cast(SUMS["discounts"]),
        "discounted": F.count("discount"),
    }
    return [known[n].alias(n) for n in names]


def again(*names: str) -> list[Column]:
    """The same measures taken over rows that are already sums."""
    known = {"first_purchase": F.min, "last_purchase": F.max}
    taken = {n: known.get(n, F.sum)(n) for n in names}
    return [(c.cast(SUMS[n]) if n in SUMS else c).alias(n) for n, c in taken.items()]


def sold(orders: DataFrame) -> DataFrame:
    return orders.where(counts_as_revenue())


def by_key(orders: DataFrame, keys: list[str | Column], *names: str) -> DataFrame:
    return orders.groupBy(*keys).agg(*measures(*names))


def by_attribute(orders: DataFrame, dimension: DataFrame, key: str, attributes: list[str],
                 names: list[str], extra: list[str | Column] | None = None,
                 members: str | None = None) -> DataFrame:
    """Measures per dimension attribute and per the ``extra`` grouping columns.

    The fact goes to key grain first and meets the dimension there, so a key with a third of the
    orders is combined before it is shuffled, and the plan is the same at every size.

    ``members`` names a column for the number of distinct keys that contribute. It is the row count
    at key grain and needs no distinct step; it excludes ``extra``.
    """
    extra = extra or []
    keyed = by_key(orders, [key, *extra], *names)
    carried = [c for c in keyed.columns if c != key and c not in names]
    aggregates = again(*names)
    if members:
        aggregates.append(F.count(F.lit(1)).alias(members))
    return keyed.join(dimension.select(key, *attributes), key).groupBy(*attributes, *carried).agg(*aggregates)


def returns_per_order(returns: DataFrame) -> DataFrame:
    return returns.groupBy("order_id").agg(F.count("return_id").alias("return_count"))


def returns_by(orders: DataFrame, returns: DataFrame, key: str) -> DataFrame:
    """Number of returns per order attribute ``key``. Joins only the orders' key columns, and
    returns counted per order, so several returns of one order cannot multiply its revenue."""
    return (returns_per_order(returns).join(orders.select("order_id", key), "order_id")
            .groupBy(key).agg(F.sum("return_count").alias("return_count")))
