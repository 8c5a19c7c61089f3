"""The analytical views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillgrain.functions.dates import as_of_column, month_of
from tillgrain.functions.ratios import mean_of, or_zero, pct
from tillgrain.operators import rfm
from tillgrain.operators.rollup import again, by_key, returns_by, sold
from tillgrain.sources.star import Star

AsOf = dt.date | str | Column | None


def monthly_revenue(star: Star) -> DataFrame:
    return (sold(star.orders)
            .groupBy(month_of("order_date").alias("month_start"))
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.sum("revenue").alias("total_revenue"),
                 F.sum("profit").alias("total_profit"),
                 F.sum("quantity").alias("units_sold"),
                 mean_of("revenue").alias("avg_order_value"))
            .select("month_start", F.year("month_start").alias("year"),
                    F.month("month_start").alias("month"), "total_orders", "total_revenue",
                    "total_profit", "units_sold", "avg_order_value")
            .orderBy("month_start"))


def sales_summary(star: Star) -> DataFrame:
    return sold(star.orders).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"),
        pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        mean_of("revenue").alias("avg_order_value"),
        F.count_distinct("customer_id").alias("active_customers"),
        F.sum("quantity").alias("units_sold"))


def customer_summary(star: Star, as_of: AsOf = None) -> DataFrame:
    """Every customer, including those that never bought."""
    bought = by_key(sold(star.orders), ["customer_id"], "orders", "revenue", "profit",
                    "first_purchase", "last_purchase")
    return star.customers.join(bought, "customer_id", "left").select(
        "customer_id", "customer_name", "region", "customer_segment", "customer_status",
        or_zero(F.col("orders")).alias("total_orders"),
        or_zero(F.col("revenue")).alias("total_revenue"),
        or_zero(F.col("profit")).alias("total_profit"),
        F.col("first_purchase").alias("first_purchase_date"),
        F.col("last_purchase").alias("last_purchase_date"),
        F.date_diff(as_of_column(as_of), F.col("last_purchase")).alias("days_since_last_purchase"))


def product_summary(star: Star) -> DataFrame:
    orders = sold(star.orders)
    sums = by_key(orders, ["product_id"], "orders", "units", "revenue", "profit", "discounts",
                  "discounted")
    returned = returns_by(orders, star.returns, "product_id")
    return (star.products.join(sums, "product_id", "left").join(returned, "product_id", "left")
            .select(
                "product_id", "product_name", "category", "sub_category",
                or_zero(F.col("orders")).alias("total_orders"),
                or_zero(F.col("units")).alias("units_sold"),
                or_zero(F.col("revenue")).alias("total_revenue"),
                or_zero(F.col("profit")).alias("total_profit"),
                pct(or_zero(F.col("profit")), F.col("revenue")).alias("profit_margin_pct"),
                or_zero(F.col("return_count")).alias("return_count"),
                pct(F.col("discounts"), F.col("discounted")).alias("avg_discount_pct")))


def region_summary(star: Star) -> DataFrame:
    """All customers of a region count, buyers or not."""
    bought = by_key(sold(star.orders), ["customer_id"], "orders", "revenue", "profit")
    return (star.customers.select("customer_id", "region").join(bought, "customer_id", "left")
            .groupBy("region")
            .agg(F.count(F.lit(1)).alias("customer_count"), *again("orders", "revenue", "profit"))
            .select("region", "customer_count",
                    or_zero(F.col("orders")).alias("total_orders"),
                    or_zero(F.col("revenue")).alias("total_revenue"),
                    or_zero(F.col("profit")).alias("total_profit"),
                    pct(or_zero(F.col("profit")), F.col("revenue")).alias("profit_margin_pct")))


def salesperson_summary(star: Star) -> DataFrame:
    """Revenue of all years against the annual target."""
    bought = by_key(sold(star.orders), ["employee_id"], "orders", "revenue", "profit", "buyers")
    return star.employees.join(bought, "employee_id", "left").select(
        "employee_id", "employee_name", "region", "department",
        F.col("target_amount").alias("annual_target"),
        or_zero(F.col("orders")).alias("total_orders"),
        or_zero(F.col("revenue")).alias("total_revenue"),
        or_zero(F.col("profit")).alias("total_profit"),
        or_zero(F.col("buyers")).alias("customer_count"),
        pct(or_zero(F.col("revenue")), F.col("target_amount")).alias("target_achievement_pct"))


def rfm_base(star: Star, as_of: AsOf = None) -> DataFrame:
    return rfm.ntile_base(star, as_of)


def rfm_segments(star: Star, as_of: AsOf = None) -> DataFrame:
    return rfm.ntile_segments(star, as_of)


def customer_churn(star: Star) -> DataFrame:
    return star.churn.join(star.customers, "customer_id").select(
        "customer_id", "customer_name", "region", "customer_segment", "churn_probability",
        "churn_prediction", "risk_level")


def register_views(spark: SparkSession, star: Star, as_of: AsOf = None) -> list[str]:
    """Make tables and views available to SQL under their names."""
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name)
    views = {
        "vw_monthly_revenue": monthly_revenue(star),
        "vw_sales_summary": sales_summary(star),
        "vw_customer_summary": customer_summary(star, as_of),
        "vw_product_summary": product_summary(star),
        "vw_region_summary": region_summary(star),
        "vw_salesperson_summary": salesperson_summary(star),
        "vw_rfm_base": rfm_base(star, as_of),
        "vw_rfm_segments": rfm_segments(star, as_of),
    }
    if star.churn is not None:
        views["vw_customer_churn"] = customer_churn(star)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
