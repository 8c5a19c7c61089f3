"""Single-figure indicators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.functions.dates import as_of_column
from tillgrain.functions.ratios import mean_of, or_zero, pct
from tillgrain.operators.rollup import by_key, sold
from tillgrain.plans.queries import active_months, top_products_by
from tillgrain.sources.star import Star

AsOf = dt.date | str | Column | None


def headline(star: Star) -> DataFrame:
    return sold(star.orders).agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"),
        pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("active_customers"))


def average_order_value(star: Star) -> DataFrame:
    return sold(star.orders).agg(mean_of("revenue").alias("avg_order_value"))


def average_profit(star: Star) -> DataFrame:
    return sold(star.orders).agg(mean_of("profit").alias("avg_profit_per_order"))


def retention_rate(star: Star) -> DataFrame:
    stayed, active = F.count_if("stayed"), F.count(F.lit(1))
    return (active_months(sold(star.orders)).groupBy("month")
            .agg(active.alias("active_customers"), stayed.alias("retained_from_prior_month"),
                 pct(stayed.cast("decimal(20,0)"), active).alias("retention_rate_pct"))
            .orderBy("month"))


def churn_rate(star: Star) -> DataFrame:
    predicted = F.count_if(F.col("churn_prediction") == 1).cast("decimal(20,0)")
    return star.churn.agg(pct(predicted, F.count(F.lit(1))).alias("churn_rate_pct"))


def average_lifetime_value(star: Star) -> DataFrame:
    return (by_key(sold(star.orders), ["customer_id"], "revenue")
            .agg(mean_of("revenue").alias("avg_customer_lifetime_value")))


def target_achievement(star: Star, as_of: AsOf = None) -> DataFrame:
    """Current year, over the (employee, month) pairs that have a target."""
    year = F.year(as_of_column(as_of))
    keys = ["employee_id", "year", "month"]
    planned = (star.targets.where(F.col("year") == year).groupBy(*keys)
               .agg(F.sum("target_amount").alias("target_amount")))
    day = F.col("order_date")
    actual = by_key(sold(star.orders).where(F.year(day) == year),
                    ["employee_id", F.year(day).alias("year"), F.month(day).alias("month")],
                    "revenue")
    revenue = F.sum(or_zero(F.col("revenue")))
    return planned.join(actual, keys, "left").agg(
        F.sum("target_amount").alias("total_target"), revenue.alias("total_actual"),
        pct(revenue, F.sum("target_amount")).alias("achievement_pct"))


def best_selling_product(star: Star) -> DataFrame:
    return top_products_by(star, "units", 1).withColumnRenamed("units", "units_sold")


def highest_revenue_product(star: Star) -> DataFrame:
    return top_products_by(star, "revenue", 1)


def highest_profit_product(star: Star) -> DataFrame:
    return top_products_by(star, "profit", 1)


def lowest_margin_product(star: Star) -> DataFrame:
    lowest = (by_key(sold(star.orders), ["product_id"], "revenue", "profit").where("revenue > 0")
              .select("product_id", pct(F.col("profit"), F.col("revenue")).alias("margin_pct"))
              .orderBy(F.asc_nulls_last("margin_pct"), "product_id").limit(1))
    return (lowest.join(star.products, "product_id")
            .select("product_id", "product_name", "margin_pct"))
