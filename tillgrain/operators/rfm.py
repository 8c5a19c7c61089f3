"""Recency, frequency and spend: two scoring schemes, kept apart.

``ntile`` scores cut the ranked customers into five equal groups, counting days to a given day.
``quantile`` scores count days to the day after the last order; recency is cut at its value
quintiles, frequency and spend at the quintiles of their rank.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.functions.dates import as_of_column
from tillgrain.functions.labels import rfm_segment
from tillgrain.operators.buckets import AFTER_ALL, VALUE, ntile_starts, with_buckets
from tillgrain.operators.rollup import by_key, sold
from tillgrain.session import pin
from tillgrain.sources.star import Star

SCORES = 5


class RepeatedEdges(ValueError):
    """Recency has too few distinct values to be cut into five bins."""


def ntile_base(star: Star, as_of: dt.date | str | Column | None = None) -> DataFrame:
    """One row per buying customer: days since the last order, orders, revenue."""
    return _base(star, as_of).join(star.customers.select("customer_id", "customer_name"),
                                   "customer_id").select(
        "customer_id", "customer_name", "recency_days", "frequency", "monetary")


def _bought(star: Star) -> DataFrame:
    sums = by_key(sold(star.orders), ["customer_id"], "last_purchase", "orders", "revenue")
    return sums.select(
        "customer_id", "last_purchase", F.col("orders").alias("frequency"),
        F.coalesce(F.col("revenue"), F.lit(0)).cast("decimal(24,2)").alias("monetary"))


def _recency(as_of: dt.date | str | Column | None) -> Column:
    return F.date_diff(as_of_column(as_of), F.col("last_purchase")).alias("recency_days")


def _base(star: Star, as_of: dt.date | str | Column | None) -> DataFrame:
    return _bought(star).select("customer_id", _recency(as_of), "frequency", "monetary")


def stored_scores(star: Star, slices: int | None = None) -> DataFrame:
    """Three scores of one to five per buying customer. The longest ago comes first in recency, on
    whatever day one counts from, so the scores hold until the orders change."""
    day = F.coalesce(F.unix_date("last_purchase").cast(VALUE), F.lit(AFTER_ALL).cast(VALUE))
    return with_buckets(pin(_bought(star)), {
        "r_score": day, "f_score": F.col("frequency"), "m_score": F.col("monetary")},
        "customer_id", ntile_starts(SCORES), slices)


def scored(star: Star, slices: int | None = None) -> Star:
    """The star with its scores; made and pinned where it has none, so that later reports share them."""
    if star.scores is not None:
        return star
    return star.with_scores(pin(stored_scores(star, slices)))


def ntile_segments(star: Star, as_of: dt.date | str | Column | None = None,
                   slices: int | None = None) -> DataFrame:
    """Base, three scores of one to five, their sum, and the segment; from the stored scores where the
    star has them."""
    scored = star.scores if star.scores is not None else stored_scores(star, slices)
    named = scored.join(star.customers.select("customer_id", "customer_name"), "customer_id")
    return named.select(
        "customer_id", "customer_name", _recency(as_of), "frequency", "monetary",
        "r_score", "f_score", "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"),
        rfm_segment().alias("segment"))


def quantile_base(star: Star) -> DataFrame:
    """One row per buying customer, with recency counted to the day after the last order.

    The last order day over all customers is taken from per-customer rows that are pinned first, so
    the fact is read once.
    """
    bought = pin(by_key(sold(star.orders), ["customer_id"], "last_purchase", "orders", "revenue"))
    latest = bought.agg(F.max("last_purchase")).first()[0]
    return bought.select(
        "customer_id",
        (F.date_diff(F.lit(latest), F.col("last_purchase")) + 1).alias("recency"),
        F.col("orders").alias("frequency"),
        F.col("revenue").alias("monetary"))


def rank_quintile_starts(n: int) -> dict[int, int]:
    """The rank at which each quintile from the second on begins, when the edges are interpolated
    quantiles of the ranks."""
    ranks = {b: (b - 1) * (n - 1) // SCORES + 2 for b in range(2, SCORES + 1)}
    return {b: rank for b, rank in ranks.items() if rank <= n}


def recency_edges(base: DataFrame) -> list[float]:
    """The six edges of five bins. Recency has at most one value per calendar day, which bounds
    the state of the percentile aggregate."""
    row = base.agg(F.percentile("recency", F.array(*[F.lit(i / SCORES) for i in range(6)]))
                   .alias("edges")).first()
    edges = row["edges"]
    if edges is None or len(set(edges)) < len(edges):
        raise RepeatedEdges(f"recency quintile edges are not distinct: {edges}")
    return edges


def recency_score(recency: Column, edges: list[float]) -> Column:
    """Bins are closed on the right; the most recent bin scores five."""
    score = F.when(recency <= F.lit(edges[1]), 5)
    for i, edge in enumerate(edges[2:5]):
        score = score.when(recency <= F.lit(edge), 4 - i)
    return score.otherwise(1)


def quantile_segments(star: Star, slices: int | None = None) -> DataFrame:
    base = quantile_base(star)
    scored = base.withColumn("r_score", recency_score(F.col("recency"), recency_edges(base)))
    scored = with_buckets(scored, {"f_score": F.col("frequency"), "m_score": F.col("monetary")},
                          "customer_id", rank_quintile_starts, slices)
    return scored.select(
        "customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"),
        rfm_segment().alias("segment"))


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("count"))
