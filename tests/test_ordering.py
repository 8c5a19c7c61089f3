"""Sliced global order against plain windows, with heavy ties."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tillgrain.operators.ordering import (exact_quantiles, ntile_of, with_ntile, with_rank,
                                          with_row_number, with_running_sums)


@pytest.fixture(scope="module")
def tied(spark):
    rng = random.Random(7)
    rows = [(i, 1 if rng.random() < 0.4 else rng.randint(0, 60)) for i in range(3000)]
    return spark.createDataFrame(rows, "id int, v int").repartition(5)


ORDER = ["v", "id"]


@pytest.mark.parametrize("slices", [None, 1, 7])
def test_row_number(tied, slices):
    got = with_row_number(tied, [F.asc(c) for c in ORDER], "rn", "n", slices)
    want = tied.withColumn("want", F.row_number().over(Window.orderBy(*ORDER)))
    joined = got.join(want, ["id", "v"])
    assert joined.count() == 3000
    assert joined.where("rn <> want or n <> 3000").count() == 0


def test_rows_spread_over_slices(tied):
    """A value that 40 % of the rows share does not fill one slice."""
    spread = tied.repartitionByRange(8, "v", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in spread.collect()) < 3000 * 0.3


@pytest.mark.parametrize("tiles", [5, 20])
def test_ntile(tied, tiles):
    got = with_ntile(tied, tiles, [F.desc("v"), F.asc("id")], "tile", 6)
    want = tied.withColumn("want", F.ntile(tiles).over(Window.orderBy(F.desc("v"), "id")))
    assert got.join(want, ["id", "v"]).where("tile <> want").count() == 0


@pytest.mark.parametrize("n", [1, 3, 4, 5, 7, 23])
def test_ntile_of_few_rows(spark, n):
    df = spark.range(1, n + 1).select(
        "id", ntile_of(F.col("id"), F.lit(n), 5).alias("tile"),
        F.ntile(5).over(Window.orderBy("id")).alias("want"))
    assert df.where("tile <> want").count() == 0


@pytest.mark.parametrize("dense", [False, True])
def test_rank(spark, tied, dense):
    df = tied.unionByName(spark.createDataFrame([(9001, None), (9002, None)], "id int, v int"))
    function = F.dense_rank if dense else F.rank
    want = df.withColumn("want", function().over(Window.orderBy(F.desc_nulls_first("v"))))
    got = with_rank(df, "v", "place", dense=dense, slices=5)
    joined = got.join(want.select("id", "want"), "id")
    assert joined.count() == 3002
    assert joined.where("place <> want").count() == 0


def test_running_sums_with_totals(tied):
    got = with_running_sums(tied, [F.asc("v"), F.asc("id")], {"upto": F.col("v")},
                            totals={"upto": "all"}, slices=4)
    window = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = tied.withColumn("want", F.sum("v").over(window))
    total = tied.agg(F.sum("v")).first()[0]
    assert got.join(want, ["id", "v"]).where(f"upto <> want or all <> {total}").count() == 0


def test_exact_quantiles(tied):
    values = [r["v"] for r in tied.collect()]
    probabilities = [0.0, 0.2, 0.5, 0.995, 1.0]
    got = exact_quantiles(tied, "v", probabilities, 5)
    for p in probabilities:
        assert got[p] == pytest.approx(float(np.quantile(values, p)))


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, v int")
    assert exact_quantiles(empty, "v", [0.5]) == {0.5: None}
