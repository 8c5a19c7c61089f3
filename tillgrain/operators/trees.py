"""Fitted classifiers as plain tables: tree nodes and linear weights that Spark or any SQL engine can score.

A forest's chance is the weighted mean of its leaves' shares; a boosted model's is the logistic of twice the
weighted sum of its leaves' values. Nodes are numbered within their tree; the first one is the root. The
tables hold a few rows per node of a fixed number of trees of bounded depth, so they are sent whole to
wherever rows are scored; a batch of rows walks a tree together, one array step per level.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

NODES = ("tree int, node int, feature int, threshold double, left int, right int, value double, "
         "weight double")
WEIGHTS = "feature string, mean double, scale double, weight double"
FOREST, BOOSTED = "forest", "boosted"


# ---- export

def _walk(java_node, tree: int, weight: float, leaf_value) -> Iterator[tuple]:
    """Rows of a tree, the root first. A left child holds what is at most the threshold."""
    waiting, number = [(java_node, 0)], 1
    while waiting:
        node, own = waiting.pop()
        if node.subtreeDepth() == 0:
            yield tree, own, None, None, None, None, leaf_value(node), weight
            continue
        split = node.split()
        yield (tree, own, split.featureIndex(), split.threshold(), number, number + 1, None, weight)
        waiting += [(node.leftChild(), number), (node.rightChild(), number + 1)]
        number += 2


def _share(node) -> float:
    """The share of the second class among a leaf's training rows."""
    counts = list(node.impurityStats().stats())
    return counts[1] / sum(counts)


def node_table(model: PipelineModel) -> DataFrame:
    """The nodes of the pipeline's last stage, a random forest or a boosted model."""
    last = model.stages[-1]
    boosted = hasattr(last, "getMaxIter")
    rows: list[tuple] = []
    for tree, (member, weight) in enumerate(zip(last.trees, last.treeWeights)):
        rows += _walk(member._java_obj.rootNode(), tree, float(weight) if boosted else 1.0,
                      (lambda n: n.prediction()) if boosted else _share)
    return SparkSession.getActiveSession().createDataFrame(rows, NODES)


def weight_table(model: PipelineModel, names: list[str]) -> DataFrame:
    """Mean, scale and weight of each feature of a scaled logistic model; the row without a name has
    the intercept."""
    scaler, last = model.stages[-2], model.stages[-1]
    rows = [(n, float(m), float(s), float(w)) for n, m, s, w in zip(
        names, scaler.mean, scaler.std, last.coefficients)]
    return SparkSession.getActiveSession().createDataFrame(
        [*rows, (None, None, None, float(last.intercept))], WEIGHTS)


# ---- scoring

def _trees(nodes: DataFrame) -> list[tuple[float, dict[str, np.ndarray]]]:
    """Every tree's weight and its nodes as arrays, by number. A leaf leads to itself; behind the last
    node stands one without a value, to which a number without a node leads."""
    rows = sorted(nodes.collect(), key=lambda r: (r["tree"], r["weight"], r["node"]))
    made = []
    for (_, weight), own in groupby(rows, key=lambda r: (r["tree"], r["weight"])):
        own = list(own)
        none = len(own)

        def column(name: str, kind: type, at_leaf) -> np.ndarray:
            return np.array([r[name] if r["feature"] is not None else at_leaf(i) for i, r in enumerate(own)]
                            + [at_leaf(none)], kind)

        def child(name: str) -> np.ndarray:
            to = column(name, np.float64, lambda i: i)  # a missing number is no number
            return np.where((to >= 0) & (to < none), to, none).astype(np.int64)

        made.append((weight, {
            "feature": column("feature", np.int64, lambda i: 0), "left": child("left"), "right": child("right"),
            "threshold": column("threshold", np.float64, lambda i: np.nan),
            "value": np.array([*(r["value"] for r in own), None], np.float64)}))
    return made


def _leaf(tree: dict[str, np.ndarray], features: np.ndarray, depth: int) -> np.ndarray:
    """The values that the rows' features lead to. At a leaf the walk stays; a missing feature goes right."""
    rows, at = np.arange(len(features)), np.zeros(len(features), np.int64)
    for _ in range(depth):
        low = features[rows, tree["feature"][at]] <= tree["threshold"][at]
        at = np.where(low, tree["left"][at], tree["right"][at])
    return tree["value"][at]


def with_tree_chance(rows: DataFrame, nodes: DataFrame, names: list[str], kind: str, depth: int,
                     chance: str = "churn_chance") -> DataFrame:
    """The rows with the chance that the trees of ``nodes`` give; ``names`` are the features by number.
    The nodes are those of one model, whose number its trees and their depth bound."""
    trees = _trees(nodes)

    @F.pandas_udf("double")
    def total_of(*features: pd.Series) -> pd.Series:
        table = np.column_stack([f.to_numpy(np.float64, na_value=np.nan) for f in features])
        total = np.zeros(len(table))
        for weight, tree in trees:
            total += weight * _leaf(tree, table, depth)
        return pd.Series(total)

    total = total_of(*[F.col(f"`{n}`").cast("double") for n in names])
    value = total / F.lit(float(sum(w for w, _ in trees))) if kind == FOREST else 1 / (1 + F.exp(-2 * total))
    return rows.withColumn(chance, value)


def with_linear_chance(rows: DataFrame, weights: DataFrame, chance: str = "churn_chance") -> DataFrame:
    """The rows with the chance of a scaled logistic model. A model has a row per feature."""
    margin = F.lit(0.0)
    for row in weights.collect():
        if row["feature"] is None:
            margin = margin + F.lit(row["weight"])
        elif row["scale"]:
            scaled = (F.col(f"`{row['feature']}`").cast("double") - row["mean"]) / row["scale"]
            margin = margin + F.lit(row["weight"]) * scaled
    return rows.withColumn(chance, 1 / (1 + F.exp(-margin)))


def logistic_gradient(rows: DataFrame, weights: DataFrame, label: str, penalty: float) -> DataFrame:
    """feature and gradient of the mean loss with its penalty at the given weights; at a fitted model's
    own weights all are near zero. The intercept has no name and no penalty."""
    scored = with_linear_chance(rows, weights, "_chance")
    miss = F.col("_chance") - F.col(label)
    terms, back = [], []
    for row in weights.collect():
        name = row["feature"]
        if name is None:
            terms.append(F.avg(miss).alias("g"))
        else:
            scaled = (F.col(f"`{name}`").cast("double") - row["mean"]) / (row["scale"] or 1.0)
            terms.append((F.avg(miss * scaled) + penalty * row["weight"]).alias("g"))
        back.append(name)
    sums = scored.agg(*[t.alias(f"g{i}") for i, t in enumerate(terms)])
    return sums.select(F.inline(F.array(*[F.struct(
        F.lit(name).cast("string").alias("feature"), F.col(f"g{i}").alias("gradient"))
        for i, name in enumerate(back)])))
