"""Exported models score like the models themselves."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tillgrain.operators import churn, trees


@pytest.fixture(scope="module")
def customers(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        frequency = rng.randint(1, 40)
        rows.append((f"C{i}", frequency, rng.random() * 9e5, rng.random() * 900, rng.random() / 4, rng.random() / 5,
                     float(rng.randint(1, 2000)), int(rng.random() < 1 / (1 + frequency / 8))))
    names = ", ".join(f"{n} double" if n != "frequency" else "frequency bigint" for n in churn.FEATURES)
    return spark.createDataFrame(rows, f"customer_id string, {names}, is_churned int").cache()


def off(made, model, rows):
    own = churn.predict(model, rows).select("customer_id", F.col("churn_chance").alias("own"))
    return made.join(own, "customer_id").agg(
        F.count("*"), F.max(F.abs(F.col("own") - F.col("churn_chance")))).first()


@pytest.mark.parametrize("name,kind,depth", [("Random Forest", trees.FOREST, 8),
                                             ("Gradient Boosting", trees.BOOSTED, 3)])
def test_trees_score_like_the_model(customers, name, kind, depth):
    model = churn.fit(customers, name)
    nodes = trees.node_table(model)
    made = trees.with_tree_chance(customers, nodes, churn.FEATURES, kind, depth)
    assert made.columns == [*customers.columns, "churn_chance"]
    count, most = off(made, model, customers)
    assert count == 400 and most < 1e-9
    # Every inner node has two children, and every other node but the root is one.
    inner = nodes.where("feature is not null").count()
    assert nodes.count() == 2 * inner + nodes.select("tree").distinct().count()


def test_weights_score_like_the_model_and_are_an_optimum(customers):
    model = churn.fit(customers, "Logistic Regression")
    weights = trees.weight_table(model, churn.FEATURES)
    count, most = off(trees.with_linear_chance(customers, weights), model, customers)
    assert count == 400 and most < 1e-9
    slope = {r["feature"]: r["gradient"] for r in trees.logistic_gradient(
        customers, weights, "is_churned", 1 / 400).collect()}
    assert set(slope) == {*churn.FEATURES, None} and max(map(abs, slope.values())) < 1e-4
    moved = weights.withColumn("weight", F.col("weight") + 0.5)
    away = trees.logistic_gradient(customers, moved, "is_churned", 1 / 400)
    assert away.agg(F.max(F.abs("gradient"))).first()[0] > 0.01


def test_a_feature_that_never_changes(spark, customers):
    flat = customers.withColumn("avg_discount", F.lit(0.1))
    model = churn.fit(flat, "Logistic Regression")
    weights = trees.weight_table(model, churn.FEATURES)
    assert off(trees.with_linear_chance(flat, weights), model, flat)[1] < 1e-9


def test_batches_walk_the_trees(spark):
    """Missing features go right, a walk that doesn't end at a leaf has no value, and no plan folds over nodes."""
    nodes = spark.createDataFrame([
        (0, 0, 0, 1.0, 1, 2, None, 2.0), (0, 1, None, None, None, None, 0.25, 2.0), (0, 2, 1, 5.0, 3, 4, None, 2.0),
        (0, 3, None, None, None, None, 0.5, 2.0), (0, 4, None, None, None, None, 1.0, 2.0),
        (1, 0, None, None, None, None, 0.5, 1.0)], trees.NODES)
    given = spark.createDataFrame([(1, 1.0, 9.0), (2, 2.0, 5.0), (3, 2.0, None), (4, None, 1.0), (5, float("nan"), 6.0)],
                                  "id int, a double, b double")
    made = trees.with_tree_chance(given, nodes, ["a", "b"], trees.FOREST, 2)
    found = {r["id"]: r["churn_chance"] for r in made.collect()}
    leaf = {1: 0.25, 2: 0.5, 3: 1.0, 4: 0.5, 5: 1.0}
    assert found == {i: pytest.approx((2 * v + 0.5) / 3) for i, v in leaf.items()}
    short = {r["id"]: r["churn_chance"] for r in trees.with_tree_chance(
        given, nodes, ["a", "b"], trees.BOOSTED, 1).collect()}
    assert short[1] == pytest.approx(1 / (1 + math.exp(-2))) and [short[i] for i in (2, 3, 4, 5)] == [None] * 4
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan and "Join" not in plan
