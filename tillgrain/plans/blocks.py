"""The blocks behind each report page.

Every page function returns its blocks as a dict of lazy DataFrames; a caller collects or writes
only those it needs. Filters apply to the blocks the pages apply them to.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillgrain.functions.labels import PERFORMANCE_TIERS, performance_tier
from tillgrain.functions.ratios import growth_pct, mean_of, or_zero, pct
from tillgrain.operators import rfm
from tillgrain.operators.ordering import with_rank
from tillgrain.operators.quality import REPORT_SCHEMA, quality_summary
from tillgrain.operators.rollup import by_attribute, by_key, sold
from tillgrain.operators.scope import (Filters, Order, equals_if_given, matches, page_after, page_info,
                                       page_of, scoped_orders, where_all)
from tillgrain.plans.queries import (acquisition_by_month, by_category, by_region, most_returned,
                                     monthly)
from tillgrain.sources.star import Star
from tillgrain.sources.warehouse import read_report

AsOf = dt.date | str | Column | None


# ---- dashboard

def trailing_growth(orders: DataFrame, places: int = 2) -> DataFrame:
    """Revenue of the twelve months up to the last order against the twelve before, one row.

    Orders are summed per day first; the last day is then found among those few rows, so the fact is
    read once.
    """
    return growth_of_days(by_key(orders, ["order_date"], "revenue"), places)


def growth_of_days(days: DataFrame, places: int = 2) -> DataFrame:
    """The same from revenue per order_date."""
    last = F.max("order_date").over(Window.partitionBy())
    day = F.col("order_date")
    recent_from, prior_from = F.add_months("last_day", -12), F.add_months("last_day", -24)
    return days.withColumn("last_day", last).agg(
        F.sum(F.when(day > recent_from, F.col("revenue"))).alias("trailing_12m"),
        F.sum(F.when((day <= recent_from) & (day > prior_from), F.col("revenue")))
        .alias("prior_12m")).withColumn(
        "yoy_growth_pct", growth_pct(F.col("trailing_12m"), F.col("prior_12m"), places))


def dashboard_kpis(star: Star, filters: Filters | None = None) -> DataFrame:
    return scoped_orders(star, filters).agg(
        F.count(F.lit(1)).alias("total_orders"),
        or_zero(F.sum("revenue")).alias("total_revenue"),
        or_zero(F.sum("profit")).alias("total_profit"),
        pct(or_zero(F.sum("profit")), F.sum("revenue")).alias("profit_margin_pct"),
        F.count_distinct("customer_id").alias("active_customers"))


def dashboard_growth(star: Star, filters: Filters | None = None) -> DataFrame:
    return trailing_growth(scoped_orders(star, filters)).select("yoy_growth_pct")


def revenue_trend(star: Star, filters: Filters | None = None) -> DataFrame:
    return monthly(scoped_orders(star, filters), "revenue", "profit").orderBy("month")


def revenue_by_region(star: Star, filters: Filters | None = None) -> DataFrame:
    return by_region(star, "revenue", orders=scoped_orders(star, filters)).orderBy(
        F.desc_nulls_first("revenue"), "region")


def revenue_by_category(star: Star, filters: Filters | None = None) -> DataFrame:
    return by_category(star, scoped_orders(star, filters), "revenue").orderBy(
        F.desc_nulls_first("revenue"), "category")


def top_product_names(star: Star, filters: Filters | None = None, n: int = 10) -> DataFrame:
    return (by_attribute(scoped_orders(star, filters), star.products, "product_id",
                         ["product_name"], ["revenue"])
            .orderBy(F.desc_nulls_first("revenue"), "product_name").limit(n))


def buyers_by_segment(star: Star, filters: Filters | None = None) -> DataFrame:
    return by_attribute(scoped_orders(star, filters), star.customers, "customer_id",
                        ["customer_segment"], ["orders"], members="customer_count").drop("orders")


def dashboard(star: Star, filters: Filters | None = None) -> dict[str, DataFrame]:
    return {
        "kpis": dashboard_kpis(star, filters),
        "yoy_growth": dashboard_growth(star, filters),
        "revenue_trend": revenue_trend(star, filters),
        "revenue_by_region": revenue_by_region(star, filters),
        "revenue_by_category": revenue_by_category(star, filters),
        "top_products": top_product_names(star, filters),
        "customer_segment_distribution": buyers_by_segment(star, filters)}


# ---- sales

def sales_trend(star: Star, filters: Filters | None = None) -> DataFrame:
    return monthly(scoped_orders(star, filters), "revenue", "orders").orderBy("month")


def _planned(star: Star) -> DataFrame:
    return star.targets.groupBy("employee_id").agg(F.sum("target_amount").alias("planned"))


def target_vs_actual(star: Star) -> DataFrame:
    """All-time targets against all-time revenue; takes no filters."""
    actual = by_key(sold(star.orders), ["employee_id"], "revenue")
    return (star.employees.join(_planned(star), "employee_id", "left")
            .join(actual, "employee_id", "left")
            .select("employee_id", "employee_name", "region",
                    or_zero(F.col("planned")).alias("target_amount"),
                    or_zero(F.col("revenue")).alias("actual_revenue"),
                    pct(or_zero(F.col("revenue")), F.col("planned")).alias("achievement_pct"))
            .orderBy(F.desc_nulls_last("achievement_pct"), "employee_id"))


def salesperson_ranking(star: Star, filters: Filters | None = None) -> DataFrame:
    bought = by_key(scoped_orders(star, filters), ["employee_id"], "revenue")
    return (with_rank(bought, "revenue", "rank")
            .join(star.employees, "employee_id")
            .select("employee_id", "employee_name", "region", "revenue", "rank")
            .orderBy(F.desc_nulls_first("revenue"), "employee_id"))


def region_ranking(star: Star, filters: Filters | None = None) -> DataFrame:
    place = F.rank().over(Window.orderBy(F.desc_nulls_first("revenue")))
    return (by_region(star, "revenue", orders=scoped_orders(star, filters))
            .withColumn("rank", place).orderBy("rank", "region"))


def sales(star: Star, filters: Filters | None = None) -> dict[str, DataFrame]:
    return {
        "monthly_trend": sales_trend(star, filters),
        "target_vs_actual": target_vs_actual(star),
        "salesperson_ranking": salesperson_ranking(star, filters),
        "region_ranking": region_ranking(star, filters)}


# ---- customers

def customer_counts(star: Star) -> DataFrame:
    """Customers in all, active ones, and those that bought, in one aggregate over customer rows."""
    buyers = sold(star.orders).select("customer_id").distinct().withColumn("bought", F.lit(1))
    listed = star.customers.select("customer_id", "customer_status", F.lit(1).alias("listed"))
    return listed.join(buyers, "customer_id", "full").agg(
        F.count("listed").alias("total_customers"),
        F.count_if(F.col("customer_status") == "Active").alias("active_customers"),
        F.count("bought").alias("purchasing_customers"))


def new_and_returning(star: Star) -> DataFrame:
    """Each customer's first order is new, every other one returning."""
    per_customer = by_key(sold(star.orders), ["customer_id"], "orders")
    firsts = F.count(F.lit(1))
    return per_customer.agg(
        firsts.alias("new_customer_orders"),
        (or_zero(F.sum("orders")) - firsts).alias("returning_customer_orders"))


def customer_growth(star: Star) -> DataFrame:
    return acquisition_by_month(star)


def segment_sizes(star: Star, as_of: AsOf = None) -> DataFrame:
    return rfm.segment_sizes(rfm.ntile_segments(star, as_of))


def matching_customers(star: Star, search: str | None = None, filters: Filters | None = None
                       ) -> DataFrame:
    """Of the filters only region and segment apply here."""
    found = where_all(star.customers, (filters or Filters()).on_customers())
    return found.where(matches(search, "customer_name", "customer_id")) if search else found


def customer_table(star: Star, search: str | None = None, filters: Filters | None = None,
                   page: int = 1, page_size: int = 25) -> DataFrame:
    return page_of(customer_list(star, search, filters),
                   [F.desc("total_revenue"), F.asc("customer_id")], page, page_size)


def customer_list(star: Star, search: str | None = None, filters: Filters | None = None
                  ) -> DataFrame:
    """All matching customers; the semi-join keeps other customers' orders out of the sums."""
    found = matching_customers(star, search, filters)
    orders = sold(star.orders)
    if search or (filters and filters.on_customers()):
        orders = orders.join(found.select("customer_id"), "customer_id", "left_semi")
    bought = by_key(orders, ["customer_id"], "revenue", "orders", "last_purchase")
    return found.join(bought, "customer_id", "left").select(
        "customer_id", "customer_name", "region", "customer_segment", "customer_status",
        or_zero(F.col("revenue")).alias("total_revenue"),
        or_zero(F.col("orders")).alias("total_orders"),
        F.col("last_purchase").alias("last_purchase_date"))


def customers(star: Star, filters: Filters | None = None, search: str | None = None,
              page: int = 1, page_size: int = 25, as_of: AsOf = None) -> dict[str, DataFrame]:
    return {
        "summary": customer_counts(star),
        "new_and_returning": new_and_returning(star),
        "customer_growth": customer_growth(star),
        "rfm_segments": segment_sizes(star, as_of),
        "customers": customer_table(star, search, filters, page, page_size),
        "pagination": page_info(matching_customers(star, search, filters), page, page_size)}


# ---- products

def product_performance(star: Star, filters: Filters | None = None) -> DataFrame:
    sums = by_key(scoped_orders(star, filters), ["product_id"], "revenue", "profit", "units")
    return (sums.join(star.products, "product_id")
            .select("product_id", "product_name", "category", "sub_category", "revenue", "profit",
                    pct(F.col("profit"), F.col("revenue")).alias("margin_pct"),
                    F.col("units").alias("units_sold")))


def best_and_worst(products: DataFrame, measure: str, best: bool, n: int = 10) -> DataFrame:
    """The first or last n of the list sorted by ``measure`` descending, a null counting as zero.
    With fewer than 2n products the two lists overlap. The last n come in descending order, too."""
    value = F.coalesce(F.col(measure), F.lit(0))
    ends = [value.desc(), F.asc("product_id")] if best else [value.asc(), F.desc("product_id")]
    picked = products.orderBy(*ends).limit(n)
    return picked if best else picked.orderBy(value.desc(), F.asc("product_id"))


def category_performance(star: Star, filters: Filters | None = None) -> DataFrame:
    return by_category(star, scoped_orders(star, filters), "revenue", "profit").orderBy(
        F.desc_nulls_first("revenue"), "category")


def products(star: Star, filters: Filters | None = None) -> dict[str, DataFrame]:
    listed = product_performance(star, filters)
    return {
        "top_10_products": best_and_worst(listed, "revenue", True),
        "bottom_10_products": best_and_worst(listed, "revenue", False),
        "highest_margin_products": best_and_worst(listed, "margin_pct", True),
        "lowest_margin_products": best_and_worst(listed, "margin_pct", False),
        "category_performance": category_performance(star, filters),
        "most_returned_products": most_returned(star),
        "all_products": listed}


# ---- regions

def region_totals(star: Star, filters: Filters | None = None) -> DataFrame:
    """Only regions with sales, and only customers that bought."""
    return (by_region(star, "orders", "revenue", "profit", orders=scoped_orders(star, filters),
                      members="customer_count")
            .select("region", "customer_count", F.col("orders").alias("total_orders"),
                    F.col("revenue").alias("total_revenue"), F.col("profit").alias("total_profit"),
                    pct(F.col("profit"), F.col("revenue")).alias("profit_margin_pct"))
            .orderBy(F.desc_nulls_first("total_revenue"), "region"))


def region_trend(star: Star, filters: Filters | None = None) -> DataFrame:
    sums = region_months(star, filters)
    before = F.lag("revenue").over(Window.partitionBy("region").orderBy("month"))
    return sums.withColumn("prev_month_revenue", before).orderBy("region", "month")


def region_months(star: Star, filters: Filters | None = None) -> DataFrame:
    month = F.trunc("order_date", "MM").alias("month")
    return by_attribute(scoped_orders(star, filters), star.customers, "customer_id", ["region"],
                        ["revenue"], extra=[month])


def regions(star: Star, filters: Filters | None = None) -> dict[str, DataFrame]:
    return {"region_summary": region_totals(star, filters),
            "region_trend": region_trend(star, filters)}


# ---- employees

def scorecard(star: Star) -> DataFrame:
    actual = by_key(sold(star.orders), ["employee_id"], "revenue", "profit", "orders", "buyers")
    return (star.employees.join(_planned(star), "employee_id", "left")
            .join(actual, "employee_id", "left")
            .select("employee_id", "employee_name", "department", "region", "joining_date",
                    F.col("target_amount").alias("annual_target"),
                    or_zero(F.col("planned")).alias("total_target_full_period"),
                    or_zero(F.col("revenue")).alias("total_revenue"),
                    or_zero(F.col("profit")).alias("total_profit"),
                    or_zero(F.col("orders")).alias("total_orders"),
                    or_zero(F.col("buyers")).alias("customer_count"),
                    pct(or_zero(F.col("revenue")), F.col("planned"))
                    .alias("target_achievement_pct"))
            .orderBy(F.desc_nulls_last("target_achievement_pct"), "employee_id"))


def tiered_scorecard(star: Star) -> DataFrame:
    return scorecard(star).withColumn("performance_tier",
                                      performance_tier(F.col("target_achievement_pct")))


def tier_counts(star: Star) -> DataFrame:
    """Tiers in display order; a tier without members is left out."""
    place = F.array_position(F.array(*[F.lit(t) for t in PERFORMANCE_TIERS]),
                             F.col("performance_tier"))
    return (tiered_scorecard(star).groupBy("performance_tier")
            .agg(F.count(F.lit(1)).alias("count")).orderBy(place))


def employees(star: Star) -> dict[str, DataFrame]:
    return {"employees": tiered_scorecard(star), "performance_tier_summary": tier_counts(star)}


# ---- churn

def _mean_probability() -> Column:
    return mean_of("churn_probability", 4)


def risk_summary(star: Star) -> DataFrame:
    return star.churn.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("count"), _mean_probability().alias("avg_probability"))


def churn_overall(star: Star) -> DataFrame:
    return star.churn.agg(_mean_probability().alias("avg_churn_probability"))


def _churn_details(star: Star, predicted: DataFrame, as_of: AsOf) -> DataFrame:
    """Predictions with the customer, what they bought, and their segment. All joins run on
    customer_id over one row per customer. The star has scores, which hold each customer's sums."""
    bought = star.scores.select("customer_id", F.col("monetary").alias("revenue"),
                                F.col("frequency").alias("orders"), "last_purchase")
    segments = rfm.ntile_segments(star, as_of).select("customer_id",
                                                      F.col("segment").alias("rfm_segment"))
    return (predicted.join(star.customers.select("customer_id", "customer_name", "region"),
                           "customer_id")
            .join(bought, "customer_id", "left").join(segments, "customer_id", "left")
            .select("customer_id", "customer_name", "region",
                    or_zero(F.col("revenue")).alias("revenue"),
                    or_zero(F.col("orders")).alias("orders"), "last_purchase", "rfm_segment",
                    "churn_probability", "risk_level"))


def churn_list(star: Star, risk_level: str | None = None, as_of: AsOf = None) -> DataFrame:
    """All predictions with their customers."""
    return _churn_details(rfm.scored(star), equals_if_given(star.churn, "risk_level", risk_level), as_of)


CHURN_ORDER = [Order("churn_probability", descending=True), Order("customer_id")]


def _churn_page(star: Star, cut: DataFrame, as_of: AsOf) -> DataFrame:
    """The rows of a page with their customers. What they bought stands beside their stored scores; without
    these, the scores need a pass over the orders anyway, and the sums come from it."""
    star = rfm.scored(star)
    return _churn_details(star, cut, as_of).orderBy(*[o.sort() for o in CHURN_ORDER])


def churn_table(star: Star, risk_level: str | None = None, page: int = 1, page_size: int = 25,
                as_of: AsOf = None) -> DataFrame:
    """A page by its number, cut from the predictions before anything is joined."""
    cut = page_of(equals_if_given(star.churn, "risk_level", risk_level),
                  [o.sort() for o in CHURN_ORDER], page, page_size)
    return _churn_page(star, cut, as_of)


def churn_table_after(star: Star, last: dict | None = None, risk_level: str | None = None,
                      page_size: int = 25, as_of: AsOf = None) -> DataFrame:
    """The page after a row of the table, or the first one."""
    cut = page_after(equals_if_given(star.churn, "risk_level", risk_level), CHURN_ORDER, last, page_size)
    return _churn_page(star, cut, as_of)


def churn(star: Star, risk_level: str | None = None, page: int = 1, page_size: int = 25,
          as_of: AsOf = None) -> dict[str, DataFrame]:
    return {
        "risk_summary": risk_summary(star),
        "overall": churn_overall(star),
        "at_risk_customers": churn_table(star, risk_level, page, page_size, as_of),
        "pagination": page_info(equals_if_given(star.churn, "risk_level", risk_level), page,
                                page_size)}


# ---- segments

def segment_profile(segments: DataFrame) -> DataFrame:
    def mean(column: str, places: int) -> Column:
        return mean_of(F.col(column).cast("decimal(24,2)"), places)
    return (segments.groupBy("segment")
            .agg(F.count(F.lit(1)).alias("count"),
                 mean("monetary", 2).alias("avg_monetary"),
                 mean("frequency", 2).alias("avg_frequency"),
                 mean("recency_days", 1).alias("avg_recency_days"))
            .orderBy(F.desc("count"), "segment"))


def segment_members(segments: DataFrame, segment: str | None = None) -> DataFrame:
    return equals_if_given(segments, "segment", segment).select(
        "customer_id", "customer_name", "recency_days", "frequency", "monetary", "r_score",
        "f_score", "m_score", "rfm_score", "segment")


def segment_table(segments: DataFrame, segment: str | None = None, page: int = 1,
                  page_size: int = 25) -> DataFrame:
    return page_of(segment_members(segments, segment),
                   [F.desc("rfm_score"), F.asc("customer_id")], page, page_size)


def segments(star: Star, segment: str | None = None, page: int = 1, page_size: int = 25,
             as_of: AsOf = None) -> dict[str, DataFrame]:
    scored = rfm.ntile_segments(star, as_of)
    return {
        "segment_summary": segment_profile(scored),
        "customers": segment_table(scored, segment, page, page_size),
        "pagination": page_info(equals_if_given(scored, "segment", segment), page, page_size)}


# ---- stored reports

_BAND = "forecast_revenue double, lower_bound double, upper_bound double"
FORECAST_REPORTS = {
    "actual_monthly_revenue": "month string, actual_revenue double",
    "forecast_next_30_days": f"date string, {_BAND}",
    "forecast_next_3_months": f"month string, {_BAND}",
    "forecast_next_6_months": f"month string, {_BAND}",
    "forecast_backtest_metrics": "MAE double, RMSE double, MAPE_pct double"}


def forecast(spark: SparkSession, reports: str) -> dict[str, DataFrame]:
    return {("backtest_error_metrics" if name == "forecast_backtest_metrics" else name):
            read_report(spark, reports, name, schema, "the forecast job")
            for name, schema in FORECAST_REPORTS.items()}


def data_quality(spark: SparkSession, reports: str) -> dict[str, DataFrame]:
    rules = read_report(spark, reports, "data_quality_report", REPORT_SCHEMA, "the load job")
    return {"summary": quality_summary(rules), "rules": rules}
