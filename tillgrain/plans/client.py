"""Values the report pages derive from their blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillgrain.functions.labels import attainment_tier
from tillgrain.functions.ratios import pct
from tillgrain.operators.scope import Filters
from tillgrain.plans import blocks
from tillgrain.sources.star import Star

SALESPEOPLE_SHOWN = 15
PRODUCTS_SHOWN = 200


def region_pivot(star: Star, filters: Filters | None = None,
                 regions: list[str] | None = None) -> DataFrame:
    """Months down, regions across. Naming the regions spares Spark the pass that looks for them."""
    grouped = blocks.region_months(star, filters).groupBy("month")
    wide = grouped.pivot("region", regions) if regions else grouped.pivot("region")
    return wide.agg(F.sum("revenue")).orderBy("month")


def actual_and_forecast(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """One series: past months with actuals, then forecast months with their band."""
    past = actual.select(F.col("month").alias("label"), F.col("actual_revenue").alias("actual"))
    ahead = forecast.select(
        F.col("month").alias("label"), F.col("forecast_revenue").alias("forecast"),
        F.col("lower_bound").alias("lower"), F.col("upper_bound").alias("upper"))
    return past.unionByName(ahead, allowMissingColumns=True)


def repeat_order_share(star: Star) -> DataFrame:
    new, returning = F.col("new_customer_orders"), F.col("returning_customer_orders")
    return blocks.new_and_returning(star).select(
        pct(returning.cast("decimal(20,0)"), new + returning).alias("repeat_order_pct"))


def attainment(star: Star) -> DataFrame:
    return blocks.target_vs_actual(star).select(
        "employee_id", "employee_name", "achievement_pct",
        attainment_tier(F.col("achievement_pct")).alias("tier"))


def risk_counts(star: Star) -> DataFrame:
    def of(level: str):
        return F.coalesce(F.sum(F.when(F.col("risk_level") == level, F.col("count"))), F.lit(0))
    return blocks.risk_summary(star).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"), of("High").alias("high"),
        of("Medium").alias("medium"), of("Low").alias("low"))


def leading_salespeople(star: Star, filters: Filters | None = None) -> DataFrame:
    return blocks.salesperson_ranking(star, filters).limit(SALESPEOPLE_SHOWN)


def leading_products(star: Star, filters: Filters | None = None) -> DataFrame:
    """The product list as shown; ordered here, so that the cut is well defined."""
    return (blocks.product_performance(star, filters)
            .orderBy(F.desc_nulls_first("revenue"), "product_id").limit(PRODUCTS_SHOWN))
