"""The business query library."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillgrain.functions.dates import as_of_column, month_of
from tillgrain.functions.labels import discount_band
from tillgrain.functions.ratios import growth_pct, mean_of, or_zero, pct, per
from tillgrain.operators.buckets import ntile_starts, with_buckets
from tillgrain.operators.ordering import with_rank
from tillgrain.operators import rfm
from tillgrain.operators.rollup import by_attribute, by_key, returns_by, sold
from tillgrain.operators.scope import enriched_orders
from tillgrain.session import pin
from tillgrain.sources.star import Star

AsOf = dt.date | str | Column | None

# Unpartitioned windows below run over frames with one row per period, region or bucket; their size
# does not follow the fact.

def _total(column: str) -> Column:
    return F.sum(column).over(Window.partitionBy())


def monthly(orders: DataFrame, *names: str) -> DataFrame:
    return by_key(orders, [month_of("order_date").alias("month")], *names)


def top_customers(star: Star, n: int = 10) -> DataFrame:
    """Names are looked up for the winners only."""
    best = (by_key(sold(star.orders), ["customer_id"], "revenue")
            .orderBy(F.desc_nulls_first("revenue"), "customer_id").limit(n))
    return (best.join(star.customers, "customer_id")
            .select("customer_id", "customer_name", F.col("revenue").alias("total_revenue"))
            .orderBy(F.desc_nulls_first("total_revenue"), "customer_id"))


def top_products(star: Star, n: int = 10) -> DataFrame:
    return top_products_by(star, "revenue", n).withColumnRenamed("revenue", "total_revenue")


def top_products_by(star: Star, measure: str, n: int) -> DataFrame:
    best = (by_key(sold(star.orders), ["product_id"], measure)
            .orderBy(F.desc_nulls_first(measure), "product_id").limit(n))
    return (best.join(star.products, "product_id")
            .select("product_id", "product_name", measure)
            .orderBy(F.desc_nulls_first(measure), "product_id"))


def revenue_by_month(star: Star) -> DataFrame:
    return monthly(sold(star.orders), "revenue").orderBy("month")


def profit_by_month(star: Star) -> DataFrame:
    return monthly(sold(star.orders), "profit").orderBy("month")


def yearly_growth(star: Star) -> DataFrame:
    before = F.lag("revenue").over(Window.orderBy("yr"))
    return (by_key(sold(star.orders), [F.year("order_date").alias("yr")], "revenue")
            .withColumn("prev_year_revenue", before)
            .withColumn("yoy_growth_pct",
                        growth_pct(F.col("revenue"), F.col("prev_year_revenue")))
            .orderBy("yr"))


def monthly_growth(star: Star) -> DataFrame:
    """Against the previous month that has orders, which need not be the calendar's."""
    before = F.lag("revenue").over(Window.orderBy("month"))
    return (monthly(sold(star.orders), "revenue")
            .withColumn("prev_month_revenue", before)
            .withColumn("mom_growth_pct",
                        growth_pct(F.col("revenue"), F.col("prev_month_revenue")))
            .orderBy("month"))


def by_region(star: Star, *names: str, orders: DataFrame | None = None,
              members: str | None = None) -> DataFrame:
    return by_attribute(sold(star.orders) if orders is None else orders, star.customers,
                        "customer_id", ["region"], list(names), members=members)


def region_ranking(star: Star) -> DataFrame:
    place = F.rank().over(Window.orderBy(F.desc_nulls_first("revenue")))
    return by_region(star, "revenue").withColumn("region_rank", place)


def salesperson_ranking(star: Star) -> DataFrame:
    bought = by_key(sold(star.orders), ["employee_id"], "revenue")
    ranked = with_rank(bought, "revenue", "sales_rank", dense=True)
    return (ranked.join(star.employees, "employee_id")
            .select("employee_id", "employee_name", "revenue", "sales_rank")
            .orderBy("sales_rank", "employee_id"))


def active_months(orders: DataFrame) -> DataFrame:
    """Distinct (customer, month), and whether the customer also bought the month before.

    The window holds at most one row per calendar month for each customer.
    """
    seen = orders.select("customer_id", month_of("order_date").alias("month")).distinct()
    before = F.lag("month").over(Window.partitionBy("customer_id").orderBy("month"))
    return seen.withColumn("stayed", before == F.add_months("month", -1))


def retention(star: Star) -> DataFrame:
    return (active_months(sold(star.orders)).groupBy("month")
            .agg(F.count_if("stayed").alias("retained_customers"),
                 F.count(F.lit(1)).alias("total_active_customers"))
            .orderBy("month"))


def repeat_customers(star: Star) -> DataFrame:
    return (by_key(sold(star.orders), ["customer_id"], "orders")
            .where("orders > 1").withColumnRenamed("orders", "order_count")
            .orderBy(F.desc("order_count"), "customer_id"))


def order_value_by_segment(star: Star) -> DataFrame:
    keyed = by_attribute(sold(star.orders), star.customers, "customer_id", ["customer_segment"],
                         ["revenue", "orders"])
    return keyed.select("customer_segment", per(F.col("revenue"), F.col("orders"))
                        .alias("avg_order_value"))


def running_revenue(star: Star) -> DataFrame:
    upto = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (monthly(sold(star.orders), "revenue")
            .withColumn("running_total", F.sum("revenue").over(upto)).orderBy("month"))


def region_share(star: Star) -> DataFrame:
    return (by_region(star, "revenue")
            .withColumn("pct_of_total", pct(F.col("revenue"), _total("revenue")))
            .orderBy(F.desc_nulls_first("revenue"), "region"))


def product_margins(star: Star) -> DataFrame:
    sums = by_key(sold(star.orders), ["product_id"], "revenue", "profit")
    return (sums.join(star.products, "product_id")
            .select("product_id", "product_name", "revenue", "profit",
                    pct(F.col("profit"), F.col("revenue")).alias("margin_pct"))
            .orderBy(F.desc_nulls_first("margin_pct"), "product_id"))


def declining_customers(star: Star, as_of: AsOf = None) -> DataFrame:
    """Both periods come out of one pass; only a customer of either period appears."""
    today = as_of_column(as_of)
    recent_from, prior_from = F.add_months(today, -3), F.add_months(today, -6)
    day = F.col("order_date")
    recent = F.sum(F.when(day >= recent_from, F.col("revenue")))
    prior = F.sum(F.when(day < recent_from, F.col("revenue")))
    zero = F.lit(0).cast("decimal(24,2)")
    return (sold(star.orders).where(day >= prior_from).groupBy("customer_id")
            .agg(F.coalesce(recent, zero).alias("rev_recent"),
                 F.coalesce(prior, zero).alias("rev_prior"))
            .where("rev_recent < rev_prior"))


def lapsed_customers(star: Star, as_of: AsOf = None, days: int = 90) -> DataFrame:
    last = by_key(sold(star.orders), ["customer_id"], "last_purchase")
    return (star.customers.select("customer_id", "customer_name")
            .join(last, "customer_id", "left")
            .where(F.col("last_purchase").isNull()
                   | (F.col("last_purchase") < F.date_sub(as_of_column(as_of), days))))


def target_achievement(star: Star, as_of: AsOf = None) -> DataFrame:
    """Targets and revenue of the current year, summed apart before they meet."""
    year = F.year(as_of_column(as_of))
    planned = (star.targets.where(F.col("year") == year).groupBy("employee_id")
               .agg(F.sum("target_amount").alias("annual_target")))
    actual = by_key(sold(star.orders).where(F.year("order_date") == year), ["employee_id"],
                    "revenue")
    return (star.employees.join(planned, "employee_id").join(actual, "employee_id", "left")
            .select("employee_id", "employee_name", "annual_target",
                    or_zero(F.col("revenue")).alias("actual_revenue"),
                    pct(or_zero(F.col("revenue")), F.col("annual_target"))
                    .alias("achievement_pct")))


def top_products_per_region(star: Star, n: int = 5) -> DataFrame:
    """Five products, by name, for each region. Spark keeps five rows per region and task before
    the shuffle, so a region's products never meet in one task."""
    sums = (enriched_orders(star, columns=["region", "product_id", "revenue"])
            .groupBy("region", "product_id").agg(F.sum("revenue").alias("revenue"))
            .join(star.products.select("product_id", "product_name"), "product_id")
            .groupBy("region", "product_name").agg(F.sum("revenue").alias("revenue")))
    place = Window.partitionBy("region").orderBy(F.desc_nulls_first("revenue"), "product_name")
    return (sums.withColumn("rn", F.row_number().over(place)).where(F.col("rn") <= n).drop("rn")
            .orderBy("region", F.desc_nulls_first("revenue"), "product_name"))


def category_totals(star: Star) -> DataFrame:
    return by_category(star, sold(star.orders), "revenue", "profit").orderBy(
        F.desc_nulls_first("revenue"), "category")


def by_category(star: Star, orders: DataFrame, *names: str) -> DataFrame:
    return by_attribute(orders, star.products, "product_id", ["category"], list(names))


def quarterly(star: Star) -> DataFrame:
    day = F.col("order_date")
    return by_key(sold(star.orders), [F.year(day).alias("year"), F.quarter(day).alias("quarter")],
                  "revenue", "profit").orderBy("year", "quarter")


def lifetime_value(star: Star) -> DataFrame:
    return (by_key(sold(star.orders), ["customer_id"], "revenue", "profit", "orders")
            .select("customer_id", F.col("revenue").alias("lifetime_revenue"),
                    F.col("profit").alias("lifetime_profit"), F.col("orders").alias("total_orders"))
            .orderBy(F.desc_nulls_first("lifetime_revenue"), "customer_id"))


def first_and_repeat(star: Star) -> DataFrame:
    """Each customer's first order against all later ones. The earliest order of a customer is an
    aggregate, so a customer with very many orders is combined task by task."""
    per_customer = sold(star.orders).groupBy("customer_id").agg(
        F.min_by("revenue", F.struct("order_date", "order_id")).alias("first_revenue"),
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    totals = per_customer.agg(
        F.sum("first_revenue").alias("first_revenue"), F.count(F.lit(1)).alias("first_orders"),
        F.sum(or_zero(F.col("revenue"))).alias("revenue"), F.sum("orders").alias("orders"))
    repeat_revenue = F.col("revenue") - or_zero(F.col("first_revenue"))
    lines = F.array(
        F.struct(F.lit("First Purchase").alias("purchase_type"),
                 F.col("first_revenue").cast("decimal(38,2)").alias("revenue"),
                 F.col("first_orders").alias("orders")),
        F.struct(F.lit("Repeat Purchase").alias("purchase_type"),
                 repeat_revenue.cast("decimal(38,2)").alias("revenue"),
                 (F.col("orders") - F.col("first_orders")).alias("orders")))
    return totals.select(F.inline(lines)).where("orders > 0")


def return_rates(star: Star) -> DataFrame:
    """All orders, cancelled ones included."""
    return _return_rates(star).orderBy(F.desc_nulls_first("return_rate_pct"), "product_id")


def _return_rates(star: Star) -> DataFrame:
    sums = by_key(star.orders, ["product_id"], "orders")
    returned = returns_by(star.orders, star.returns, "product_id")
    returns = or_zero(F.col("return_count"))
    return (sums.join(returned, "product_id", "left")
            .join(star.products.select("product_id", "product_name"), "product_id")
            .select("product_id", "product_name", F.col("orders").alias("total_orders"),
                    returns.alias("total_returns"),
                    pct(returns.cast("decimal(20,0)"), F.col("orders")).alias("return_rate_pct")))


def most_returned(star: Star, n: int = 10) -> DataFrame:
    return _return_rates(star).orderBy(F.desc_nulls_first("return_rate_pct"),
                                       "product_id").limit(n)


def order_margin() -> Column:
    """Margin of one order as a fraction, null on zero revenue."""
    return F.col("profit") / F.nullif(F.col("revenue"), F.lit(0))


def discount_impact(star: Star) -> DataFrame:
    """The mean of the orders' own margins, not the margin of the sums."""
    margin = order_margin()
    return (sold(star.orders).where("revenue > 0")
            .groupBy(discount_band(F.col("discount")).alias("discount_band"))
            .agg(F.round(F.avg(margin.cast("double")) * 100, 2).alias("avg_margin_pct"),
                 F.count(F.lit(1)).alias("orders"))
            .orderBy("discount_band"))


def _by_revenue(star: Star, tiles: int, name: str) -> DataFrame:
    """Buying customers with their bucket, the highest revenue first; none counts as highest."""
    spent = pin(by_key(sold(star.orders), ["customer_id"], "revenue"))
    return with_buckets(spent, {name: -F.col("revenue")}, "customer_id", ntile_starts(tiles))


def high_value_customers(star: Star, tiles: int = 20) -> DataFrame:
    return (_by_revenue(star, tiles, "bucket").where("bucket = 1").drop("bucket")
            .orderBy(F.desc_nulls_first("revenue"), F.asc("customer_id")))


def at_risk_customers(star: Star, as_of: AsOf = None) -> DataFrame:
    return (rfm.ntile_segments(star, as_of)
            .where(F.col("segment").isin("At Risk", "Can't Lose Them"))
            .select("customer_id", "customer_name", "recency_days", "frequency", "monetary",
                    "segment")
            .orderBy(F.desc("monetary"), "customer_id"))


def revenue_concentration(star: Star) -> DataFrame:
    return (_by_revenue(star, 5, "quintile").groupBy("quintile").agg(F.sum("revenue").alias("revenue"))
            .withColumn("pct_of_total", pct(F.col("revenue"), _total("revenue")))
            .orderBy("quintile"))


def salesperson_months(star: Star) -> DataFrame:
    before = F.lag("revenue").over(Window.partitionBy("employee_id").orderBy("month"))
    return (by_key(sold(star.orders), ["employee_id", month_of("order_date").alias("month")],
                   "revenue")
            .withColumn("prev_month_revenue", before).orderBy("employee_id", "month"))


def region_margins(star: Star) -> DataFrame:
    return (by_region(star, "revenue", "profit")
            .select("region", pct(F.col("profit"), F.col("revenue")).alias("margin_pct"))
            .orderBy(F.desc_nulls_first("margin_pct"), "region"))


def forecast_input(star: Star) -> DataFrame:
    return revenue_by_month(star)


def acquisition_by_month(star: Star) -> DataFrame:
    return (star.customers.groupBy(month_of("acquisition_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("new_customers")).orderBy("month"))


def most_discounted(star: Star, n: int = 10) -> DataFrame:
    """All orders, cancelled ones included."""
    sums = by_key(star.orders, ["product_id"], "discounts", "discounted")
    best = (sums.select("product_id",
                        pct(F.col("discounts"), F.col("discounted")).alias("avg_discount_pct"))
            .orderBy(F.desc_nulls_first("avg_discount_pct"), "product_id").limit(n))
    return (best.join(star.products, "product_id")
            .select("product_id", "product_name", "avg_discount_pct")
            .orderBy(F.desc_nulls_first("avg_discount_pct"), "product_id"))
