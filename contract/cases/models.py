"""Segments by quantiles, churn and forecasts."""

import datetime as dt
from functools import lru_cache, reduce

from pyspark.sql import Window, functions as F

from contract.cases.views import SEGMENT
from contract.mapping import money, sql
from contract.registry import case, raw_case
from tillgrain.functions.labels import risk_level
from tillgrain.operators import churn, forecast, rfm, trees
from tillgrain.plans import blocks, client, jobs
from tillgrain.session import pin, scratch_path
from tillgrain.sources.linestar import star_from_lines
from tillgrain.sources.warehouse import read_report

# ---- segments by quantiles

QUANTILES = {
    "base": (("cust",), "select customer_id, cast((select max(last_day) from cust) - last_day + 1 as int) as recency, n as frequency, rc as mc from cust"),
    "ranked": (("base",), """
select *, (select quantile_cont(cast(recency as double), [0.2,0.4,0.6,0.8]) from base) as e, count(*) over () as n,
  row_number() over (order by frequency, customer_id) as fr, row_number() over (order by mc, customer_id) as mr from base"""),
    "scored": (("ranked",), """
select customer_id, recency, frequency, mc, case when recency <= e[1] then 5 when recency <= e[2] then 4 when recency <= e[3] then 3
  when recency <= e[4] then 2 else 1 end as r_score, cast(greatest(1, (5*(fr-1)+n-2)//(n-1)) as int) as f_score,
  cast(greatest(1, (5*(mr-1)+n-2)//(n-1)) as int) as m_score from ranked"""),
}
_SCORED = f"""select customer_id, recency, frequency, {money('mc')} as monetary, r_score, f_score, m_score,
  cast(r_score+f_score+m_score as int) as rfm_score, {SEGMENT} as segment from scored"""
case("R01_quantile_base", rfm.quantile_base, sql(
    f"select customer_id, recency, frequency, {money('mc')} as monetary from base", **QUANTILES))


def _recency(star):
    base = rfm.quantile_base(star)
    return base.select("customer_id", rfm.recency_score(F.col("recency"), rfm.recency_edges(base)).alias("r_score"))


case("R02_recency_score", _recency, sql("select customer_id, r_score from scored", **QUANTILES))
case("R03_rank_scores", lambda s: rfm.quantile_segments(s).select("customer_id", "f_score", "m_score"),
     sql("select customer_id, f_score, m_score from scored", **QUANTILES))
case("R04_quantile_segments", rfm.quantile_segments, sql(_SCORED, **QUANTILES))
case("R05_segment_sizes", lambda s: rfm.segment_sizes(rfm.quantile_segments(s)),
     sql(f"select segment, count(*) as count from ({_SCORED}) group by segment", **QUANTILES))


def _segments_report(spark, folder):
    home = scratch_path(spark, "reports")
    jobs.run_segments(star_from_lines(spark, folder), home)
    return read_report(spark, home, "rfm_segments", "customer_id bigint, recency int, frequency bigint, monetary double, r_score int, "
                       "f_score int, m_score int, rfm_score int, segment string", "the segment job")


raw_case("S05_segments_report", _segments_report, sql(_SCORED, **QUANTILES))

# ---- churn: features, split and metrics in SQL


def _features(cutoff: str) -> tuple:
    return (("sold", "ret_order"), f"""
select customer_id, count(*) filter (where seen) as frequency, cast(sum(rc) filter (where seen) as double)/100 as total_spend,
  cast(sum(rc) filter (where seen) as double)/100/count(*) filter (where seen) as avg_order_value,
  cast(sum(dt) filter (where seen) as double)/10000/count(*) filter (where seen) as avg_discount,
  cast(coalesce(sum(r) filter (where seen),0) as double)/count(*) filter (where seen) as return_rate,
  cast({cutoff} - min(order_date) filter (where seen) as int) as customer_tenure_days_at_cutoff,
  cast({cutoff} - max(order_date) filter (where seen) as int) as days_since_last_purchase,
  cast(count(*) filter (where not seen) = 0 as int) as is_churned, cast(coalesce(sum(r) filter (where seen),0) as bigint) as return_count
from (select s.*, r.n as r, order_date <= {cutoff} as seen from sold s left join ret_order r on r.order_id=s.order_id)
group by customer_id having count(*) filter (where seen) > 0""")


_LAST = "(select max(order_date) from sold)"
_TRAIN, _SCORE = {"ft": _features(f"({_LAST}-120)")}, {"ft": _features(_LAST)}
_F = ", ".join(churn.FEATURES)
case("C01_features", lambda s: churn.features_as_of(s, dt.date(2000, 6, 30)),
     sql("select * from ft", ft=_features("date '2000-06-30'")))
case("C02_training_set", churn.training_set, sql(f"select customer_id, {_F}, is_churned from ft", **_TRAIN))
case("C03_scoring_set", churn.scoring_set, sql(f"select customer_id, {_F}, days_since_last_purchase from ft", **_SCORE))
_SPLIT = {**_TRAIN, "sized": (("ft",), """
select *, row_number() over (partition by is_churned order by md5(concat(customer_id, ':42')), customer_id) as k,
  count(*) over () as n, sum(is_churned) over () as c from ft"""),
          "split": (("sized",), f"""
select customer_id, {_F}, is_churned, k <= case when is_churned = 1 then floor(ceil(n*0.25)*c/n+0.5)
  else ceil(n*0.25)-floor(ceil(n*0.25)*c/n+0.5) end as is_test from sized""")}
case("C04_stratified_split", lambda s: churn.stratified_split(churn.training_set(s)).select("customer_id", "is_churned", "is_test"),
     sql("select customer_id, is_churned, is_test from split", **_SPLIT))


def _standard(star):
    split = pin(churn.stratified_split(churn.training_set(star)))
    scaled = churn.standardised(split.where("not is_test"), split)
    return scaled.select("customer_id", *[F.round(c, 6).alias(c) for c in churn.FEATURES])


case("C05_standardised", _standard, sql("select customer_id, " + ", ".join(
    f"round(({c}-avg({c}) filter (where not is_test) over ())/stddev_samp({c}) filter (where not is_test) over (),6) as {c}"
    for c in churn.FEATURES) + " from split", **_SPLIT))

# Metrics of given predictions: the stand-in scores against the training labels.


def _judged(star):
    scores = star.churn.select("customer_id", F.col("churn_probability").alias("churn_chance"), F.col("churn_prediction").alias("predicted"))
    return churn.training_set(star).join(scores, "customer_id")


_METRICS_SQL = """
select cast(tp+tn as double)/(tp+tn+fp+fn) as accuracy, case when tp+fp=0 then 0 else cast(tp as double)/(tp+fp) end as precision,
  case when tp+fn=0 then 0 else cast(tp as double)/(tp+fn) end as recall, case when 2*tp+fp+fn=0 then 0 else cast(2*tp as double)/(2*tp+fp+fn) end as f1_score,
  cast(u as double)/(2*p*q) as roc_auc, tn, fp, fn, tp
from (select count(*) filter (where is_churned=0 and g=0) as tn, count(*) filter (where is_churned=0 and g=1) as fp,
    count(*) filter (where is_churned=1 and g=0) as fn, count(*) filter (where is_churned=1 and g=1) as tp,
    sum(is_churned) as p, sum(1-is_churned) as q, sum(is_churned*r2) - sum(is_churned)*(sum(is_churned)+1) as u
  from (select is_churned, churn_prediction as g, 2*rank() over (order by ct) + count(*) over (partition by ct) - 1 as r2
    from ft join churn using (customer_id)))"""
case("C09_metrics", lambda s: churn.evaluate(_judged(s)), sql(_METRICS_SQL, "churn", **_TRAIN))
case("C12_risk_level", lambda s: s.churn.select("customer_id", risk_level(F.col("churn_probability")).alias("risk_level")),
     sql("select customer_id, risk_level from churn", "churn"))


# Scoring from exported tables: a given forest, a given boosted model and given weights, over the customers' features.
_TREES = [(t, 0, f, cut, 1, 2, None) for t, (f, cut) in enumerate(((0, 30.0), (1, 900000.0), (4, 0.1)))] + [
    row for t, (f, cut) in enumerate(((1, 400000.0), (5, 2000.0), (3, 0.12)))
    for row in ((t, 1, f, cut, 3, 4, None), (t, 2, None, None, None, None, 0.15 + 0.2 * t), (t, 3, None, None, None, None, 0.9 - 0.1 * t),
                (t, 4, None, None, None, None, 0.45))]
_GIVEN_NODES = [(*row, (0.5, 1.0, 0.25)[row[0]]) for row in _TREES]
_GIVEN_WEIGHTS = [("frequency", 35.0, 8.0, -0.7), ("total_spend", 900000.0, 250000.0, 0.25), ("return_rate", 0.08, 0.05, 0.4), (None, None, None, -0.3)]


def _literal(value) -> str:
    return "null" if value is None else f"'{value}'" if isinstance(value, str) else repr(value)


def _values(rows: list, names: str) -> str:
    listed = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return f"select * from (values {listed}) as v({names})"


_NODE_SQL = {
    "nodes": ((), _values(_GIVEN_NODES, "tree, node, feature, threshold, l, r, leaf, weight")),
    "x": (("ft",), f"select customer_id, [{', '.join(f'cast({c} as double)' for c in churn.FEATURES)}] as f from ft")}
_WALKED = """
walked as (select customer_id, tree, 0 as at from x, (select distinct tree from nodes)
  union all select w.customer_id, w.tree, case when x.f[n.feature + 1] <= n.threshold then n.l else n.r end
  from walked w join nodes n on n.tree = w.tree and n.node = w.at and n.feature is not null join x on x.customer_id = w.customer_id),
leaves as (select customer_id, w.tree, leaf, weight from walked w join nodes n on n.tree = w.tree and n.node = w.at where n.feature is null)"""
_BAND_SQL = """case when c <= 0.33 then 'Low' when c <= 0.66 then 'Medium' else 'High' end"""


def _chance_sql(value: str) -> str:
    return "with recursive " + sql("", "x", **_SCORE, **_NODE_SQL).strip().removeprefix("with ") + f""",{_WALKED}
select customer_id, round(c, 5) as churn_chance, cast(c >= 0.5 as int) as predicted, {_BAND_SQL.replace('c <=', 'round(c, 5) <=')} as risk_level
from (select customer_id, {value} as c from leaves group by customer_id)"""


def _from_nodes(star, kind):
    spark = star.orders.sparkSession
    made = trees.with_tree_chance(churn.scoring_set(star), spark.createDataFrame(_GIVEN_NODES, trees.NODES), churn.FEATURES, kind, 2)
    return _called(made)


def _called(rows):
    chance = F.round("churn_chance", 5)
    return rows.select("customer_id", chance.alias("churn_chance"), (F.col("churn_chance") >= 0.5).cast("int").alias("predicted"),
                       risk_level(chance).alias("risk_level"))


case("C07_forest_from_nodes", lambda s: _from_nodes(s, trees.FOREST), _chance_sql("sum(weight * leaf) / sum(weight)"))
case("C08_boosting_from_nodes", lambda s: _from_nodes(s, trees.BOOSTED), _chance_sql("1 / (1 + exp(-2 * sum(weight * leaf)))"))
_MARGIN = " + ".join(f"({w!r}) * (cast({n} as double) - {m!r}) / {sd!r}" if n else f"({w!r})" for n, m, sd, w in _GIVEN_WEIGHTS)
case("C06_chance_from_weights", lambda s: _called(trees.with_linear_chance(
    churn.scoring_set(s), s.orders.sparkSession.createDataFrame(_GIVEN_WEIGHTS, trees.WEIGHTS))), sql(f"""
select customer_id, round(c, 5) as churn_chance, cast(c >= 0.5 as int) as predicted, {_BAND_SQL.replace('c <=', 'round(c, 5) <=')} as risk_level
from (select customer_id, 1 / (1 + exp(-({_MARGIN}))) as c from ft)""", **_SCORE))


@lru_cache(maxsize=4)
def _remembered(spark, folder):
    """The star with its history, joined once per session and folder."""
    return churn.remembered(star_from_lines(spark, folder))


def _exported(spark, folder):
    """How far chances from exported tables lie from the models' own, over every customer to score; and the largest gradient of
    the logistic model's loss at its weights. All are zero but for rounding."""
    star = _remembered(spark, folder)
    split = pin(churn.stratified_split(churn.training_set(star)))
    train, rows = split.where("not is_test"), pin(churn.scoring_set(star))
    parts, models = [], churn.fit_all(train)
    for name, kind, depth in ((churn.MODELS[1], trees.FOREST, 8), (churn.MODELS[2], trees.BOOSTED, 3)):
        model = models[name]
        own = churn.predict(model, rows).select("customer_id", F.col("churn_chance").alias("own"))
        made = trees.with_tree_chance(rows, trees.node_table(model), churn.FEATURES, kind, depth)
        parts.append(made.join(own, "customer_id").agg(
            F.lit(name).alias("model"), F.round(F.max(F.abs(F.col("own") - F.col("churn_chance"))), 9).alias("off")))
    model = models[churn.MODELS[0]]
    table = trees.weight_table(model, churn.FEATURES)
    parts.append(trees.logistic_gradient(train, table, "is_churned", 1.0 / train.count()).agg(
        F.lit(churn.MODELS[0]).alias("model"), F.round(F.max(F.abs("gradient")), 4).alias("off")))
    return reduce(lambda a, b: a.unionByName(b), parts)


raw_case("C11_exported_models_agree", _exported, " union all ".join(
    f"select '{name}' as model, cast(0 as double) as off" for name in churn.MODELS))


@lru_cache(maxsize=4)
def _split(spark, folder):
    return pin(churn.stratified_split(churn.training_set(_remembered(spark, folder))))


@lru_cache(maxsize=12)
def _fitted(spark, folder, name):
    """One model, fitted once per session and folder."""
    return churn.fit(_split(spark, folder).where("not is_test"), name)


@lru_cache(maxsize=4)
def _trained(spark, folder):
    split = _split(spark, folder)
    return churn.compare(churn.fit_all(split.where("not is_test")), split.where("is_test"))


for _key, _name in (("C06_logistic_regression", churn.MODELS[0]), ("C07_random_forest", churn.MODELS[1]),
                    ("C08_gradient_boosting", churn.MODELS[2])):
    raw_case(_key, lambda spark, folder, name=_name: churn.predict(
        _fitted(spark, folder, name), churn.scoring_set(_remembered(spark, folder))).select(
        "customer_id", "churn_chance", "predicted"))
raw_case("C10_model_comparison", lambda spark, folder: _trained(spark, folder).comparison.withColumn(
    "is_best", F.col("model") == _trained(spark, folder).best))
raw_case("C11_scores", lambda spark, folder: churn.score(
    _trained(spark, folder).best_model, churn.scoring_set(_remembered(spark, folder))))

# ---- forecasts

_DAILY = {"span": (("sold",), "select min(order_date) as a, max(order_date) as z from sold"),
          "days": (("span",), "select cast(unnest(generate_series(a, z, interval 1 day)) as date) as date from span"),
          "daily": (("days", "sold"), """
select 'total' as series, d.date, coalesce(sum(rc),0) as c from days d left join sold s on s.order_date=d.date group by d.date""")}
case("P01_daily_series", forecast.daily_series, sql(f"select series, date, {money('c')} as y from daily", **_DAILY))
case("P01_daily_series_by_region", lambda s: forecast.daily_series(s, "region"), sql(f"""
select r.region as series, d.date, {money('coalesce(sum(rc),0)')} as y from days d cross join (select distinct region from customers) r
left join (select order_date, region, rc from sold join customers using (customer_id)) s on s.order_date=d.date and s.region=r.region
group by r.region, d.date""", "customers", **_DAILY))
case("P02_monthly_series", lambda s: forecast.actual_monthly(forecast.daily_series(s)), sql(
    f"select series, strftime(date,'%Y-%m') as month, {money('sum(c)')} as actual_revenue from daily group by 1, 2", **_DAILY))
case("P03_smoothing_by_region", lambda s: forecast.fit(
    forecast.as_arrays(forecast.daily_series(s, "region")), forecast.DAILY_SEASON))
case("P04_daily_forecast", lambda s: forecast.daily_forecast(forecast.daily_series(s)))
case("P04_daily_forecast_by_category", lambda s: forecast.daily_forecast(forecast.daily_series(s, "category")))
case("P05_backtest", lambda s: forecast.backtest(forecast.daily_series(s)))
case("P05_backtest_by_region", lambda s: forecast.backtest(forecast.daily_series(s, "region")))


def _week_before(star):
    """Errors of a given prediction: the value seven days earlier, on the last thirty days."""
    days = forecast.daily_series(star, "region")
    order = Window.partitionBy("series").orderBy("date")
    points = days.select("series", F.col("y").cast("double").alias("actual"),
                         F.lag(F.col("y").cast("double"), 7).over(order).alias("predicted"),
                         F.row_number().over(Window.partitionBy("series").orderBy(F.desc("date"))).alias("back"))
    return forecast.error_metrics(points.where("back <= 30"))


case("P05_error_metrics", _week_before, sql("""
select series, round(avg(abs(y-p)),2) as "MAE", round(sqrt(avg((y-p)*(y-p))),2) as "RMSE", round(avg(abs((y-p)/nullif(y,0)))*100,2) as "MAPE_pct"
from (select *, lag(y,7) over (partition by series order by date) as p, row_number() over (partition by series order by date desc) as back
  from (select r.region as series, d.date, cast(coalesce(sum(rc),0) as double)/100 as y from days d cross join (select distinct region from customers) r
    left join (select order_date, region, rc from sold join customers using (customer_id)) s on s.order_date=d.date and s.region=r.region
    group by r.region, d.date)) where back <= 30 group by series""", "customers", **_DAILY))
case("P06_monthly_forecast", lambda s: forecast.monthly_forecast(forecast.daily_series(s)))
case("P06_monthly_forecast_by_region", lambda s: forecast.monthly_forecast(forecast.daily_series(s, "region")))


# Smoothing with given weights, against a recursion over the days or months.
_GIVEN = (0.2, 0.05, 0.1)
_REGIONAL = {**_DAILY, "by_day": (("days", "sold", "customers"), """
select r.region as series, d.date, cast(coalesce(sum(rc),0) as double)/100 as y from days d cross join (select distinct region from customers) r
left join (select order_date, region, rc from sold join customers using (customer_id)) s on s.order_date=d.date and s.region=r.region group by r.region, d.date""")}


def _recursion(source: str, season: int, held: int = 0) -> dict:
    """Level, trend, season and errors step by step, without the last ``held`` values of a series."""
    a, b, g = _GIVEN
    return {
        "numbered": ((), f"""
select series, y, i, n, case when n >= {2 * season} then {season} else 0 end as m from (
  select series, y, date, row_number() over (partition by series order by date) - 1 as i, count(*) over (partition by series) - {held} as n
  from {source}) where i < n"""),
        "walk": ((), f"""
select series, cast(0 as bigint) as i, y as level, cast(0 as double) as trend,
  list_transform(range(0, greatest(m, 1)), lambda k: cast(0 as double)) as season, cast(0 as double) as sse, cast(0 as double) as total
from numbered where i = 0
union all
select series, i + 1, risen, trend + {b} * (risen - level - trend),
  case when m > 1 then list_transform(season, lambda s, k: case when k - 1 = i % m then s + {g} * e else s end) else season end,
  sse + e * e, total + e
from (select *, ahead + {a} * e as risen from (select *, y - ahead - season[(case when m > 1 then i % m else 0 end) + 1] as e
  from (select w.*, n.y, n.m, w.level + w.trend as ahead from walk w join numbered n on n.series = w.series and n.i = w.i)))"""),
        "state": ((), """
select w.series, cast(n.n as int) as n, cast(n.m as int) as season_length, level, trend, season, sse,
  sqrt(greatest(sse / n.n - (total / n.n) * (total / n.n), 0)) as resid_std
from walk w join (select distinct series, n, m from numbered) n on n.series = w.series and n.n = w.i""")}


def _state_sql(body: str, source: tuple, season: int, held: int = 0) -> str:
    names, extra = source
    first = sql("", *names, **extra).strip()
    rest = ",\n".join(f"{n} as ({q})" for n, (_, q) in _recursion("source", season, held).items())
    return f"with recursive {first.removeprefix('with ')},\n{rest}\n{body}"


_DAYS_OF = (("customers",), {**_REGIONAL, "source": (("by_day",), "select series, date, y from by_day")})
_MONTHS_OF = (("customers",), {**_REGIONAL, "source": (("by_day",), """
select series, date_trunc('month', date) as date, sum(y) as y from by_day group by 1, 2""")})
_VALUE = "level + h * trend + season[(case when season_length > 1 then (n + h - 1) % season_length else 0 end) + 1]"


def _bands(steps: int, when: str, name: str) -> str:
    return f"""select series, cast(h as int) as step, {when} as {name}, round(v, 2) as forecast_revenue,
  round(greatest(v - 1.96 * resid_std, 0), 2) as lower_bound, round(v + 1.96 * resid_std, 2) as upper_bound
from (select s.*, h, {_VALUE} as v, (select max(date) from source) as last from state s, range(1, {steps + 1}) r(h))"""


def _regions(star):
    return forecast.daily_series(star, "region")


case("P03_state_for_given_weights", lambda s: forecast.with_weights(*_GIVEN)(
    forecast.as_arrays(_regions(s)), forecast.DAILY_SEASON).select(
    "series", "n", "season_length", *[F.round(c, 4).alias(c) for c in ("level", "trend", "resid_std")],
    F.round(F.col("season")[3], 4).alias("fourth_of_season"), F.round(F.col("sse") / 1e6, 2).alias("sse_millions")),
    _state_sql("""select series, n, season_length, round(level, 4) as level, round(trend, 4) as trend, round(resid_std, 4) as resid_std,
  round(season[4], 4) as fourth_of_season, round(sse / 1e6, 2) as sse_millions from state""", _DAYS_OF, 7))
case("P04_bands_for_given_weights", lambda s: forecast.daily_forecast(_regions(s), 30, forecast.with_weights(*_GIVEN)),
     _state_sql(_bands(30, "strftime(last + to_days(cast(h as int)), '%Y-%m-%d')", "date"), _DAYS_OF, 7))
case("P06_bands_for_given_weights", lambda s: forecast.monthly_forecast(_regions(s), 6, forecast.with_weights(*_GIVEN)),
     _state_sql(_bands(6, "strftime(last + to_months(cast(h as int)), '%Y-%m')", "month"), _MONTHS_OF, 12))
case("P05_backtest_for_given_weights", lambda s: forecast.backtest(_regions(s), 30, forecast.with_weights(*_GIVEN)),
     _state_sql(f"""select series, round(avg(abs(y - v)), 2) as "MAE", round(sqrt(avg((y - v) * (y - v))), 2) as "RMSE",
  round(avg(abs((y - v) / nullif(y, 0))) * 100, 2) as "MAPE_pct"
from (select s.*, h, {_VALUE} as v from state s, range(1, 31) r(h)) join (
  select series, y, row_number() over (partition by series order by date) as k from source) p using (series)
where k = n + h group by series""", _DAYS_OF, 7, 30))


def _given_summary(star):
    """The stored summary of a comparison and a backtest with known results."""
    spark = star.orders.sparkSession
    home = scratch_path(spark, "summary")
    jobs.write_report(churn.evaluate(_judged(star)).select(F.lit("given").alias("model"), *churn.METRICS), home, "churn_model_comparison")
    jobs.write_report(forecast.backtest(forecast.daily_series(star), 30, forecast.with_weights(*_GIVEN)).drop("series"), home,
                      "forecast_backtest_metrics")
    return jobs.run_evaluation(spark, home).withColumn("value", F.round("value", 9))


_TOTAL_OF = (("churn",), {**_DAILY, **_TRAIN, "source": (("daily",), "select series, date, cast(c as double)/100 as y from daily")})
_ERRORS = {"MAE": "avg(abs(y - v))", "RMSE": "sqrt(avg((y - v) * (y - v)))", "MAPE_pct": "avg(abs((y - v) / nullif(y, 0))) * 100"}
case("P07_summary_of_given_results", _given_summary, _state_sql(
    "select 'churn model comparison' as section, 'given' as subject, metric, round(cast(value as double), 9) as value from (unpivot (select "
    + ", ".join(f"cast({m} as double) as {m}" for m in churn.METRICS) + f" from ({_METRICS_SQL})) on " + ", ".join(churn.METRICS)
    + f""" into name metric value value)
union all select 'forecast backtest (30-day holdout)', 'Holt-Winters', metric, value from (
  select unnest({list(_ERRORS)}) as metric, unnest([{', '.join(f'round({e}, 2)' for e in _ERRORS.values())}]) as value
  from (select s.*, h, {_VALUE} as v from state s, range(1, 31) r(h)) join (
    select series, y, row_number() over (partition by series order by date) as k from source) p using (series) where k = n + h)""", _TOTAL_OF, 7, 30))


@lru_cache(maxsize=4)
def _forecast_reports(spark, folder):
    home = scratch_path(spark, "reports")
    jobs.run_forecast(star_from_lines(spark, folder), home)
    return home


def _evaluation(spark, folder):
    home = _forecast_reports(spark, folder)
    jobs.write_report(_trained(spark, folder).comparison.select("model", *churn.METRICS), home, "churn_model_comparison")
    return jobs.run_evaluation(spark, home)


raw_case("P07_model_evaluation", _evaluation)
raw_case("A31_forecast_page", lambda spark, folder: blocks.forecast(spark, _forecast_reports(spark, folder))["actual_monthly_revenue"],
         sql(f"select strftime(date,'%Y-%m') as month, {money('sum(c)')} as actual_revenue from daily group by 1", **_DAILY))
raw_case("A31_forecast_page_ahead", lambda spark, folder: blocks.forecast(spark, _forecast_reports(spark, folder))["forecast_next_3_months"])


def _stitched(star):
    """Actuals followed by a given forecast: the same months ten years on, with a fixed band."""
    actual = forecast.actual_monthly(forecast.daily_series(star)).drop("series")
    later = F.concat((F.substring("month", 1, 4).cast("int") + 10).cast("string"), F.substring("month", 5, 3))
    value = F.col("actual_revenue")
    ahead = actual.select(later.alias("month"), value.alias("forecast_revenue"),
                          (value - 1).alias("lower_bound"), (value + 1).alias("upper_bound"))
    return client.actual_and_forecast(actual, ahead)


case("U02_actual_and_forecast", _stitched, sql("""
select label, y as actual, cast(null as double) as forecast, cast(null as double) as lower, cast(null as double) as upper from months_of
union all select concat(cast(substring(label,1,4) as int)+10, substring(label,5,3)), null, y, y-1, y+1 from months_of""",
    months_of=(("daily",), f"select strftime(date,'%Y-%m') as label, {money('sum(c)')} as y from daily group by 1"), **_DAILY))
