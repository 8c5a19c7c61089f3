import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import by, d, make_star, order, rows
from tillgrain.session import pin
from tillgrain.functions import smoothing
from tillgrain.operators import churn, forecast, rfm


# ---- segments

def customer_days(counts):
    """One star row list: customer i ordered counts[i] times, most recently on a day of its own."""
    orders, n = [], 0
    for i, times in enumerate(counts):
        for t in range(times):
            day = pd.Timestamp("2024-06-01") - pd.Timedelta(days=3 * i + 40 * t)
            n += 1
            orders.append(order(f"O{n}", str(day.date()), f"C{i:03d}",
                                revenue=f"{10 + (i * 37) % 91}.00"))
    return orders


@pytest.mark.parametrize("n", [5, 8, 23])
def test_quantile_scores_equal_pandas(spark, n):
    rng = random.Random(n)
    counts = [rng.randint(1, 3) for _ in range(n)]
    star = make_star(spark, customer_days(counts),
                     customers=[(f"C{i:03d}", "North", "X") for i in range(n)])
    got = rfm.quantile_segments(star, slices=3).toPandas().sort_values("customer_id")
    assert list(got["r_score"]) == list(pd.qcut(got["recency"], 5, labels=[5, 4, 3, 2, 1]))
    for column, score in (("frequency", "f_score"), ("monetary", "m_score")):
        ranks = got[column].astype(float).rank(method="first")
        assert list(got[score]) == list(pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]))
    assert got["recency"].min() == 1


def test_equal_recency_cannot_be_cut(spark):
    star = make_star(spark, [order(f"O{i}", "2024-01-01", f"C{i}") for i in range(6)],
                     customers=[(f"C{i}", "North", "X") for i in range(6)])
    with pytest.raises(rfm.RepeatedEdges):
        rfm.quantile_segments(star)


def test_tile_sizes_differ_by_one_at_most(spark):
    star = make_star(spark, customer_days([1] * 23),
                     customers=[(f"C{i:03d}", "North", "X") for i in range(23)])
    got = rfm.ntile_segments(star, "2024-07-01", slices=4)
    for score in ("r_score", "f_score", "m_score"):
        sizes = [r["count"] for r in got.groupBy(score).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


# ---- churn

@pytest.fixture(scope="module")
def planted(spark):
    """Customers with few orders stop buying; frequent ones go on."""
    rng, orders, n = random.Random(3), [], 0
    for i in range(160):
        loyal = i % 2 == 0
        for t in range(8 if loyal else rng.randint(1, 3)):
            day = pd.Timestamp("2024-12-31") - pd.Timedelta(
                days=rng.randint(0, 110) if loyal and t == 0 else rng.randint(130, 700))
            n += 1
            orders.append(order(f"O{n}", str(day.date()), f"C{i:03d}",
                                revenue=f"{rng.randint(20, 200)}.00"))
    orders.append(order("OX", "2024-12-31", "C000"))
    return make_star(spark, orders, customers=[(f"C{i:03d}", "North", "X") for i in range(160)],
                     returns=[("R1", "O1", "2024-12-31"), ("R2", "O1", "2024-12-31")])


def test_features_stop_at_the_cutoff(spark):
    star = make_star(spark, [
        order("O1", "2024-01-01", "C1", revenue="100.00", discount="0.1"),
        order("O2", "2024-03-01", "C1", revenue="50.00"),
        order("O3", "2024-09-01", "C1"), order("O4", "2024-02-01", "C2"),
        order("O5", "2024-09-01", "C3"), order("O6", "2024-02-01", "C1", status="Cancelled")],
        returns=[("R1", "O1", "2024-01-09"), ("R2", "O3", "2024-09-09")])
    got = by(churn.features_as_of(star, d("2024-06-01")), "customer_id")
    assert set(got) == {"C1", "C2"}  # C3 came after the cutoff
    one = got["C1"]
    assert (one["frequency"], one["total_spend"], one["avg_order_value"]) == (2, 150.0, 75.0)
    assert (one["return_count"], one["return_rate"], one["avg_discount"]) == (1, 0.5, 0.05)
    assert one["customer_tenure_days_at_cutoff"] == 152
    assert (one["is_churned"], got["C2"]["is_churned"]) == (0, 1)


def test_split_has_exact_shares_and_is_stable(spark, planted):
    features = churn.training_set(planted)
    split = churn.stratified_split(features, slices=3).select("customer_id", "is_churned",
                                                              "is_test")
    again = churn.stratified_split(features.repartition(3)).select(*split.columns)
    assert sorted(split.collect()) == sorted(again.collect())
    sizes = {(r["is_churned"], r["is_test"]): r["count"]
             for r in split.groupBy("is_churned", "is_test").count().collect()}
    total = sum(sizes.values())
    assert sum(v for (_, test), v in sizes.items() if test) == math.ceil(total / 4)
    for label in (0, 1):
        share = sizes[label, True] / (sizes[label, True] + sizes[label, False])
        assert share == pytest.approx(0.25, abs=0.02)


def test_one_class_cannot_be_split(spark):
    star = make_star(spark, [order("O1", "2024-01-01", "C1"), order("O2", "2024-12-01", "C1")])
    with pytest.raises(ValueError):
        churn.stratified_split(churn.training_set(star))


def brute_auc(pairs):
    wins = sum((p > q) + 0.5 * (p == q) for l, p in pairs if l for k, q in pairs if not k)
    positives = sum(l for l, _ in pairs)
    return wins / (positives * (len(pairs) - positives))


def test_auc_with_ties_equals_pair_counting(spark):
    rng = random.Random(5)
    pairs = [(rng.randint(0, 1), rng.choice([0.1, 0.2, 0.5, 0.5, 0.9])) for _ in range(200)]
    df = spark.createDataFrame([(l, p, int(p >= 0.5)) for l, p in pairs],
                               "is_churned int, churn_chance double, predicted int")
    got = rows(churn.evaluate(df))[0]
    assert got["roc_auc"] == pytest.approx(brute_auc(pairs))
    assert churn.rank_auc(df, slices=3).first()[0] == pytest.approx(brute_auc(pairs))
    assert got["tn"] + got["fp"] + got["fn"] + got["tp"] == 200


def test_metrics_without_a_denominator_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1, 0), (0, 0.2, 0)],
                               "is_churned int, churn_chance double, predicted int")
    got = rows(churn.evaluate(df))[0]
    assert (got["accuracy"], got["precision"], got["recall"], got["f1_score"]) == (1, 0, 0, 0)
    assert got["roc_auc"] is None


def test_models_find_planted_churn(planted):
    trained = churn.train_and_select(churn.training_set(planted),
                                     ("Logistic Regression", "Random Forest"))
    table = by(trained.comparison, "model")
    assert all(r["roc_auc"] > 0.8 for r in table.values())
    assert trained.best == max(table, key=lambda m: table[m]["roc_auc"])
    scores = churn.score(trained.best_model, churn.scoring_set(planted)).toPandas()
    assert len(scores) == 160
    probability = scores["churn_probability"].astype(float)
    assert ((probability >= 0.5) == (scores["churn_prediction"] == 1)).mean() > 0.99
    want = pd.cut(probability, [-0.01, 0.33, 0.66, 1.01], labels=["Low", "Medium", "High"])
    assert list(scores["risk_level"]) == list(want)


# ---- forecasts

def slow_smooth(y, m, level, trend, season, a, b, g):
    """The recursion, one value at a time."""
    season, sse = list(season), 0.0
    for i, value in enumerate(y):
        s = season[i % m] if m > 1 else 0.0
        ahead = level + trend
        new = a * (value - s) + (1 - a) * ahead
        new_trend = b * (new - level) + (1 - b) * trend
        sse += (value - ahead - s) ** 2
        if m > 1:
            season[i % m] = g * (value - ahead) + (1 - g) * s
        level, trend = new, new_trend
    return sse, level, trend, season


def test_batch_smoothing_equals_the_plain_loop():
    rng = np.random.default_rng(1)
    y = rng.normal(100, 10, (3, 60)) + 5 * np.sin(np.arange(60) * 2 * np.pi / 7)
    start = smoothing._start(y, 7)
    grid = [(0.1, 0.05, 0.2), (0.6, 0.0, 0.0), (0.01, 0.4, 0.3)]
    weights = np.repeat(np.array(grid)[None], 3, axis=0)
    sse, _, level, trend, season = smoothing._smooth(y, 7, start, *np.moveaxis(weights, 2, 0))
    for s in range(3):
        for c, (a, b, g) in enumerate(grid):
            want = slow_smooth(y[s], 7, start[0][s], start[1][s], start[2][s], a, b, g)
            assert sse[s, c] == pytest.approx(want[0])
            assert level[s, c] == pytest.approx(want[1])
            assert trend[s, c] == pytest.approx(want[2])
            assert [x[s, c] for x in season] == pytest.approx(want[3])


def test_chosen_weights_beat_the_whole_grid():
    rng = np.random.default_rng(2)
    y = np.cumsum(rng.normal(0, 1, (2, 80)), axis=1) + 50
    best = smoothing._fit_batch(y, 7)
    start = smoothing._start(y, 7)
    for a in (0.0, 0.3, 0.9):
        for b in (0.0, 0.2):
            for g in (0.0, 0.2):
                for s in range(2):
                    sse = slow_smooth(y[s], 7, start[0][s], start[1][s], start[2][s], a, b, g)[0]
                    assert best["sse"][s] <= sse * 1.02


def arrays_of(spark, series):
    points = [(name, (pd.Timestamp("2023-01-01") + pd.Timedelta(days=i)).date(), float(v))
              for name, values in series.items() for i, v in enumerate(values)]
    return forecast.as_arrays(spark.createDataFrame(points, "series string, date date, y double"))


def test_noise_free_season_is_continued(spark):
    season = [5, -3, 0, 2, -4, 1, -1]
    values = [100 + 0.5 * t + season[t % 7] for t in range(1, 92)]
    state = forecast.fit(arrays_of(spark, {"a": values, "b": [v * 2 for v in values]}), 7)
    got = forecast.forecast(state, 14).toPandas()
    for name, factor in (("a", 1), ("b", 2)):
        part = got[got["series"] == name].sort_values("step")["forecast_revenue"]
        want = [factor * (100 + 0.5 * t + season[t % 7]) for t in range(92, 106)]
        assert list(part) == pytest.approx(want, abs=0.05)


def test_bounds_enclose_and_stay_above_zero(spark):
    rng = np.random.default_rng(4)
    got = forecast.forecast(forecast.fit(
        arrays_of(spark, {"x": rng.normal(3, 8, 70)}), 7), 10).toPandas()
    assert (got["lower_bound"] >= 0).all()
    assert (got["forecast_revenue"] <= got["upper_bound"]).all()


@pytest.mark.parametrize("n", [1, 2, 5, 13])
def test_short_series_get_level_and_trend_only(spark, n):
    state = forecast.fit(arrays_of(spark, {"s": [10.0 + i for i in range(n)]}), 7).first()
    assert state["season_length"] == 0
    assert state["level"] == pytest.approx(10.0 + n - 1, abs=0.01)


def test_days_without_orders_are_zero(spark):
    star = make_star(spark, [order("O1", "2024-01-01", "C1"), order("O2", "2024-01-04", "C2"),
                             order("O3", "2024-01-09", "C1", status="Cancelled")])
    got = [float(r["y"]) for r in forecast.daily_series(star).orderBy("date").collect()]
    assert got == [100.0, 0.0, 0.0, 100.0]
    north = forecast.daily_series(star, "region").where("series = 'North'").orderBy("date")
    assert [float(r["y"]) for r in north.collect()] == [100.0, 0.0, 0.0, 0.0]


def test_error_metrics_skip_zero_days_in_mape(spark):
    points = spark.createDataFrame([("s", 10.0, 8.0), ("s", 0.0, 3.0)],
                                   "series string, actual double, predicted double")
    got = rows(forecast.error_metrics(points))[0]
    assert got == {"series": "s", "MAE": 2.5, "RMSE": 2.55, "MAPE_pct": 20.0}


def test_backtest_leaves_out_short_series(spark):
    star = make_star(spark, [order("O1", "2024-01-01", "C1"), order("O2", "2024-01-10", "C1")])
    assert forecast.backtest(forecast.daily_series(star)).count() == 0


def test_history_counts_returns_once_per_order(spark):
    star = make_star(spark, [
        order("O1", "2024-01-01", "C1"), order("O2", "2024-01-05", "C1"), order("O3", "2024-03-01", "C2"),
        order("O4", "2024-01-02", None), order("O5", "2024-01-03", "C2", status="Cancelled")],
        returns=[("R1", "O1", "2024-01-03"), ("R2", "O1", "2024-01-04"), ("R3", "O3", "2024-03-02"),
                 ("R4", "O4", "2024-01-03"), ("R5", "O5", "2024-01-04")])
    kept = churn.remembered(star)
    assert churn.remembered(kept) is kept and kept.history.count() == 4
    assert churn.last_order_day(kept) == d("2024-03-01")
    early = by(churn.features_as_of(kept, d("2024-02-01")), "customer_id")
    assert {c: (r["frequency"], r["return_count"]) for c, r in early.items()} == {"C1": (2, 2), None: (1, 0)}
    late = by(churn.features_as_of(kept, d("2024-03-01")), "customer_id")
    assert late["C2"]["return_rate"] == 1.0 and late["C1"]["return_rate"] == 1.0


def test_a_forest_is_fitted_in_no_more_tasks_than_run_at_once(spark, planted, monkeypatch):
    seen = []
    fitted = churn.Pipeline.fit
    monkeypatch.setattr(churn.Pipeline, "fit", lambda self, df: (seen.append(df.rdd.getNumPartitions()), fitted(self, df))[1])
    many = pin(churn.training_set(planted)).repartition(40)
    models = churn.fit_all(many, churn.MODELS[:1])
    assert set(models) == {churn.MODELS[0]} and seen[0] <= spark.sparkContext.defaultParallelism
