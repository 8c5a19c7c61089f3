"""Connected components of a graph that is spread over the cluster, by alternating large and small
stars: every round each node hands its larger, then its smaller neighbours to the smallest one it
knows. Minima are taken by partial aggregation, so a node with very many edges costs a row per task,
and the edges meet them in a join that Spark may split. Each round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillgrain.session import pin


def _turned(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _turned(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger u to the smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    handed = edges.join(least, "u")
    return (handed.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v")))
            .where("u != v").distinct())


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that isn't its
    root. ``edges`` has long columns u and v in any direction; loops, repeats and rows with a null
    are passed over."""
    now = pin(edges.where("u != v").select(F.greatest("u", "v").alias("u"),
                                           F.least("u", "v").alias("v")).distinct())
    seen = _print(now)
    while seen[0]:
        now = pin(_small_star(_large_star(now)))
        then, seen = seen, _print(now)
        if then == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
