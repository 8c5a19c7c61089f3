"""Revenue forecasts for many series at once by additive exponential smoothing.

Spark sums, fills and splits the series; a small array function searches weights for a batch of them
inside a task; smoothing with given weights is a fold over a series' values in the JVM, and forecasts
and errors are Spark columns over the state that it leaves. A series has one value per
calendar day, so its length is bounded by the calendar and not by the number of orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.functions import smoothing
from tillgrain.operators.rollup import by_attribute, by_key, sold
from tillgrain.session import pin
from tillgrain.sources.star import Star

TOTAL = "total"
DAILY_SEASON = 7
MONTHLY_SEASON = 12
BAND = 1.96
HOLDOUT_DAYS = 30

_OWNER = {"region": ("customers", "customer_id"), "customer_segment": ("customers", "customer_id"),
          "category": ("products", "product_id"), "product_name": ("products", "product_id"),
          "employee_name": ("employees", "employee_id")}



# ---- series

def daily_series(star: Star, by: str | None = None) -> DataFrame:
    """(series, date, y) with a zero for each day without orders, from the first order day of all
    series to the last. Only those two days reach the driver."""
    orders = sold(star.orders)
    if by is None:
        sums = by_key(orders, ["order_date"], "revenue").withColumn("series", F.lit(TOTAL))
    else:
        table, key = _OWNER[by]
        sums = by_attribute(orders, getattr(star, table), key, [by], ["revenue"],
                            extra=["order_date"]).withColumnRenamed(by, "series")
    sums = pin(sums.select("series", F.col("order_date").alias("date"),
                           F.col("revenue").alias("y")))
    first, last = sums.agg(F.min("date"), F.max("date")).first()
    if first is None:
        return sums
    days = sums.select("series").distinct().select(
        "series", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return days.join(sums, ["series", "date"], "left").select(
        "series", "date", F.coalesce(F.col("y"), F.lit(0)).cast("decimal(24,2)").alias("y"))


def monthly_series(daily: DataFrame) -> DataFrame:
    """Month sums, the last, partial month included."""
    return (daily.groupBy("series", F.trunc("date", "MM").alias("date"))
            .agg(F.sum("y").cast("decimal(24,2)").alias("y")))


def as_arrays(series: DataFrame) -> DataFrame:
    """One row per series: its dates and values in order. The collected lists are bounded by the
    calendar. The explicit partition count keeps small rows with heavy fits in separate tasks."""
    tasks = series.sparkSession.sparkContext.defaultParallelism
    pairs = F.array_sort(F.collect_list(F.struct("date", F.col("y").cast("double").alias("y"))))
    return (series.groupBy("series").agg(pairs.alias("p"))
            .select("series", F.col("p.date").alias("dates"), F.col("p.y").alias("y"))
            .repartition(tasks, "series"))


# ---- fitted states

Fitter = Callable[[DataFrame, int], DataFrame]


def smoothed(rows: DataFrame) -> DataFrame:
    """Run each series through additive smoothing with its own weights. ``rows``: series, y,
    season_length, alpha, beta, gamma, and level, trend and season before the first value. A season
    below two steps stays as it is. Gives the state after the last value, the spread of the one-step
    errors around their mean, and the sum of their squares."""
    alpha, beta, gamma, m = (F.col(c) for c in ("alpha", "beta", "gamma", "season_length"))

    def step(state: Column, point: Column) -> Column:
        place = F.when(m > 1, point["i"] % F.greatest(m, F.lit(1))).otherwise(0)
        ahead = state["level"] + state["trend"]
        error = point["y"] - ahead - F.get(state["season"], place)
        return _moved(state, F.struct(place.alias("place"), ahead.alias("ahead"), error.alias("error")))

    def _moved(state: Column, now: Column) -> Column:
        # A transform over one element names the step's values, so that each is computed once.
        return F.transform(F.array(now), lambda x: _after(state, x))[0]

    def _after(state: Column, x: Column) -> Column:
        risen = x["ahead"] + alpha * x["error"]
        season = F.when(m > 1, F.transform(state["season"], lambda s, k: F.when(
            k == x["place"], s + gamma * x["error"]).otherwise(s))).otherwise(state["season"])
        return F.struct(
            risen.alias("level"),
            (state["trend"] + beta * (risen - state["level"] - state["trend"])).alias("trend"),
            season.alias("season"), (state["sse"] + x["error"] * x["error"]).alias("sse"),
            (state["total"] + x["error"]).alias("total"))

    zero = F.lit(0.0)
    start = F.struct(F.col("level").alias("level"), F.col("trend").alias("trend"),
                     F.col("season").alias("season"), zero.alias("sse"), zero.alias("total"))
    points = F.transform("y", lambda y, i: F.struct(y.alias("y"), i.alias("i")))
    end, n = F.col("_end"), F.size("y")
    mean = end["total"] / n
    return rows.withColumn("_end", F.aggregate(points, start, step)).select(
        "series", n.alias("n"), "season_length", "alpha", "beta", "gamma", end["level"].alias("level"),
        end["trend"].alias("trend"), end["season"].alias("season"),
        F.sqrt(F.greatest(end["sse"] / n - mean * mean, zero)).alias("resid_std"), end["sse"].alias("sse"))


def fit(arrays: DataFrame, season_length: int) -> DataFrame:
    """One fitted state per series."""
    return smoothed(arrays.select("series", "y").mapInPandas(smoothing.batch_fitter(season_length),
                                                             smoothing.WEIGHTS))


def with_weights(alpha: float, beta: float, gamma: float) -> Fitter:
    """Smoothing with given weights, from the first value as level, without trend and season. As in
    fitting, less than two whole seasons leave the season out."""
    def fitted(arrays: DataFrame, season_length: int) -> DataFrame:
        m = F.when(F.size("y") >= 2 * season_length, season_length).otherwise(0)
        return smoothed(arrays.select(
            "series", "y", m.alias("season_length"),
            *[F.lit(float(w)).alias(n) for n, w in (("alpha", alpha), ("beta", beta), ("gamma", gamma))],
            F.get("y", F.lit(0)).alias("level"), F.lit(0.0).alias("trend"),
            F.array_repeat(F.lit(0.0), F.greatest(m, F.lit(1))).alias("season")))
    return fitted


# ---- forecasts

def _ahead(h: Column) -> Column:
    """Value ``h`` steps after the last one."""
    turn = F.col("season_length") > 1
    place = F.when(turn, (F.col("n") + h - 1) % F.nullif(F.col("season_length"), F.lit(0))
                   ).otherwise(0)
    return F.col("level") + h * F.col("trend") + F.get("season", place.cast("int"))


def forecast(state: DataFrame, steps: int) -> DataFrame:
    """(series, step, forecast_revenue, lower_bound, upper_bound), rounded; lower is never below
    zero."""
    ahead = state.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    ahead = ahead.withColumn("_value", _ahead(F.col("step")))
    spread = BAND * F.col("resid_std")
    return ahead.select(
        "series", "step", F.round("_value", 2).alias("forecast_revenue"),
        F.round(F.greatest(F.col("_value") - spread, F.lit(0.0)), 2).alias("lower_bound"),
        F.round(F.col("_value") + spread, 2).alias("upper_bound"))


def _last_dates(arrays: DataFrame) -> DataFrame:
    return arrays.select("series", F.array_max("dates").alias("last"))


_BANDS = ["forecast_revenue", "lower_bound", "upper_bound"]


def daily_forecast(daily: DataFrame, days: int = 30, fitter: Fitter = fit) -> DataFrame:
    arrays = as_arrays(daily)
    ahead = forecast(fitter(arrays, DAILY_SEASON), days).join(_last_dates(arrays), "series")
    day = F.date_add("last", F.col("step"))
    return ahead.select("series", "step", F.date_format(day, "yyyy-MM-dd").alias("date"), *_BANDS)


def monthly_forecast(daily: DataFrame, months: int = 6, fitter: Fitter = fit) -> DataFrame:
    arrays = as_arrays(monthly_series(daily))
    ahead = forecast(fitter(arrays, MONTHLY_SEASON), months).join(_last_dates(arrays), "series")
    month = F.add_months("last", F.col("step"))
    return ahead.select("series", "step", F.date_format(month, "yyyy-MM").alias("month"), *_BANDS)


def actual_monthly(daily: DataFrame) -> DataFrame:
    return monthly_series(daily).select("series", F.date_format("date", "yyyy-MM").alias("month"),
                                        F.round("y", 2).alias("actual_revenue"))


# ---- errors on held-out days

def backtest_points(daily: DataFrame, horizon: int = HOLDOUT_DAYS, fitter: Fitter = fit
                    ) -> DataFrame:
    """(series, step, actual, predicted) for the last ``horizon`` days, fitted on those before."""
    arrays = as_arrays(daily).where(F.size("y") > horizon)
    known = arrays.select("series", F.slice("y", F.lit(1), F.size("y") - horizon).alias("y"))
    held = arrays.select("series", F.posexplode(F.slice("y", -horizon, horizon))
                         .alias("pos", "actual"))
    guessed = fitter(known, DAILY_SEASON).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")).select(
        "series", "step", _ahead(F.col("step")).alias("predicted"))
    return (held.select("series", (F.col("pos") + 1).alias("step"), "actual")
            .join(guessed, ["series", "step"]))


def error_metrics(points: DataFrame) -> DataFrame:
    """MAE, RMSE and MAPE per series; days with a zero actual are left out of MAPE."""
    miss = F.col("actual") - F.col("predicted")
    relative = F.abs(miss / F.nullif(F.col("actual"), F.lit(0.0)))
    return points.groupBy("series").agg(
        F.round(F.avg(F.abs(miss)), 2).alias("MAE"),
        F.round(F.sqrt(F.avg(miss * miss)), 2).alias("RMSE"),
        F.round(F.avg(relative) * 100, 2).alias("MAPE_pct"))


def backtest(daily: DataFrame, horizon: int = HOLDOUT_DAYS, fitter: Fitter = fit) -> DataFrame:
    return error_metrics(backtest_points(daily, horizon, fitter))
