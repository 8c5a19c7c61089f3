"""Buckets by selected edge rows against plain windows, with heavy ties."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import make_star, order
from tillgrain.operators import buckets, rfm
from tillgrain.operators.buckets import ntile_starts, with_buckets


@pytest.fixture(scope="module")
def tied(spark):
    rng = random.Random(7)
    rows = [(f"k{i:05d}", 1 if rng.random() < 0.4 else rng.randint(0, 60),
             None if rng.random() < 0.05 else rng.random() * 1e6) for i in range(3000)]
    return spark.createDataFrame(rows, "id string, v int, w double").repartition(5).cache()


@pytest.mark.parametrize("tiles", [5, 20])
def test_several_orders_at_once(tied, tiles):
    got = with_buckets(tied, {"a": F.col("v"), "b": -F.col("v"), "c": F.col("w")}, "id",
                       ntile_starts(tiles), 6)
    for name, by in (("a", F.asc("v")), ("b", F.desc("v")), ("c", F.round("w", 6).asc_nulls_first())):
        want = tied.withColumn("want", F.ntile(tiles).over(Window.orderBy(by, "id")))
        off = got.select("id", name).join(want.select("id", "want"), "id").where(f"{name} <> want")
        assert off.count() == 0, name


def test_a_sketch_that_is_off_changes_nothing(tied, monkeypatch):
    monkeypatch.setattr(buckets, "ACCURACY", 10 ** 9)  # too narrow a range around a coarse guess
    monkeypatch.setattr(buckets.F, "percentile_approx",
                        lambda v, shares, n: F.array(*[F.lit(3.0) for _ in shares]))
    got = with_buckets(tied, {"a": F.col("v")}, "id", ntile_starts(5))
    want = tied.withColumn("want", F.ntile(5).over(Window.orderBy("v", "id")))
    assert got.join(want.select("id", "want"), "id").where("a <> want").count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 23])
def test_few_rows(spark, n):
    df = spark.range(1, n + 1)
    got = with_buckets(df, {"a": F.lit(1)}, "id", ntile_starts(5))
    want = df.withColumn("want", F.ntile(5).over(Window.orderBy("id")))
    assert got.join(want, "id").where("a = want").count() == n


def test_rank_quintiles_follow_interpolated_edges():
    for n in range(0, 40):
        starts = rfm.rank_quintile_starts(n)
        for rank in range(1, n + 1):
            want = max(1, -(-(rank - 1) * 5 // (n - 1))) if n > 1 else 1
            assert want == max([1, *(b for b, first in starts.items() if rank >= first)])


def test_scores_hold_on_any_day(spark):
    rng = random.Random(3)
    star = make_star(spark, [order(f"O{i}", f"2024-{rng.randint(1, 4):02d}-{rng.randint(1, 28):02d}",
                                   f"C{rng.randint(0, 60)}", revenue=f"{rng.randint(1, 40)}.00")
                             for i in range(300)], customers=[(f"C{i}", "North", "X") for i in range(61)])
    live = {r["customer_id"]: r for r in rfm.ntile_segments(star, "2024-07-01").collect()}
    from tillgrain.sources.star import Star
    stored = Star(**{t: df for t, df in star.tables().items()}, scores=rfm.stored_scores(star))
    for day, off in (("2024-07-01", 0), ("2025-07-01", 365)):
        for r in rfm.ntile_segments(stored, day).collect():
            was = live[r["customer_id"]].asDict()
            assert r.asDict() == {**was, "recency_days": was["recency_days"] + off}
