"""Insight sentences, each built from one aggregate and kept only while its condition holds.

Every function returns at most one row (insight_id, category, text, value); ``all_insights`` is
their union. Most of them need the same few sums per day, customer, product, salesperson and
class of discount: ``Grains`` takes these in one pass over the orders, and ``all_insights`` hands them to all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillgrain.functions.ratios import counts_as_revenue, pct, per
from tillgrain.operators.rollup import again, by_key, returns_by, sold
from tillgrain.plans.blocks import growth_of_days
from tillgrain.plans.queries import order_margin
from tillgrain.session import pin
from tillgrain.sources.star import Star


# Fixed values in the functions below: the sentences, their numbers and categories, and their limits.

def _one(value: Column) -> Column:
    """A number with one decimal, as text."""
    return F.round(value, 1).cast("decimal(20,1)").cast("string")


def _insight(df: DataFrame, number: int, category: str, value: Column, *text: str | Column
             ) -> DataFrame:
    parts = [F.lit(t) if isinstance(t, str) else t for t in text]
    return df.select(F.lit(number).alias("insight_id"), F.lit(category).alias("category"),
                     F.concat(*parts).alias("text"), value.cast("double").alias("value"))


_KEYS = {"day": "order_date", "customer": "customer_id", "product": "product_id",
         "salesperson": "employee_id"}


def _discount_class() -> Column:
    edge = F.lit("0.15").cast("decimal(5,4)")
    return F.when(F.col("discount") > edge, "high").when(F.col("discount") <= edge, "low")


class Grains:
    """Sums over the orders per day, customer, product, salesperson, and class of discount, from one pass
    over them."""

    def __init__(self, star: Star) -> None:
        # A row of orders counts once in each grain; its parts are combined before they are shuffled.
        kept = counts_as_revenue()
        names = list(_KEYS.values())
        sets = F.array(*[F.struct((F.lit(grain) if key else _discount_class()).alias("grain"), *[
            (F.col(c) if c == key else F.lit(None)).cast(star.orders.schema[c].dataType).alias(f"k_{c}")
            for c in names]) for grain, key in {**_KEYS, "discount": None}.items()])
        rows = star.orders.select(
            F.inline(sets), F.when(kept, F.col("revenue")).alias("revenue"),
            F.when(kept, F.col("profit")).alias("profit"), kept.cast("int").alias("kept"),
            F.when(kept & (F.col("revenue") > 0), order_margin().cast("double")).alias("margin"))
        margin = F.when(F.col("grain").isin("high", "low"), F.col("margin"))
        self._sums = pin(rows.groupBy("grain", *[f"k_{c}" for c in names]).agg(
            F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
            F.sum("kept").alias("orders"), F.count(F.lit(1)).alias("all_orders"),
            F.sum(margin).alias("margin"), F.count(margin).alias("margins")))

    def of(self, grain: str) -> DataFrame:
        """The key, revenue, profit and orders of keys with orders that count."""
        key = _KEYS[grain]
        return (self._sums.where((F.col("grain") == grain) & (F.col("orders") > 0))
                .select(F.col(f"k_{key}").alias(key), "revenue", "profit", "orders"))

    def all_orders(self, grain: str) -> DataFrame:
        """The key and all its orders, cancelled ones included."""
        key = _KEYS[grain]
        return self._sums.where(F.col("grain") == grain).select(
            F.col(f"k_{key}").alias(key), F.col("all_orders").alias("orders"))

    def margins(self) -> DataFrame:
        """The mean margin of orders with a high and with a low discount, as one row."""
        mean = F.col("margin") / F.col("margins")
        return self._sums.where(F.col("grain").isin("high", "low") & (F.col("margins") > 0)).agg(
            *[F.max(F.when(F.col("grain") == c, mean)).alias(c) for c in ("high", "low")])


def _of(star: Star, grains: Grains | None, grain: str, *names: str) -> DataFrame:
    """Sums per key of a grain: those at hand, or by a pass of their own."""
    if grains is not None:
        return grains.of(grain).select(_KEYS[grain], *names)
    return by_key(sold(star.orders), [_KEYS[grain]], *names)


def _by_attribute(star: Star, grains: Grains | None, grain: str, attribute: str, *names: str) -> DataFrame:
    table = {"customer": star.customers, "product": star.products}[grain]
    return (_of(star, grains, grain, *names).join(table.select(_KEYS[grain], attribute), _KEYS[grain])
            .groupBy(attribute).agg(*again(*names)))


def revenue_change(star: Star, grains: Grains | None = None) -> DataFrame:
    change = F.col("yoy_growth_pct")
    rows = growth_of_days(_of(star, grains, "day", "revenue"), 1).where(change.isNotNull())
    return _insight(rows, 1, "Revenue", change, "Revenue ",
                    F.when(change >= 0, "increased").otherwise("decreased"), " ",
                    _one(F.abs(change)), "% over the trailing 12 months compared to the prior "
                    "12-month period.")


def leading_region(star: Star, grains: Grains | None = None) -> DataFrame:
    best = _by_attribute(star, grains, "customer", "region", "revenue").orderBy(F.desc_nulls_first("revenue"), "region").limit(1)
    return _insight(best, 2, "Regional", F.col("revenue"), "The ", F.col("region"),
                    " region generates the highest revenue at ₹",
                    F.format_number(F.round("revenue", 0), 0), ".")


def thin_margin_category(star: Star, grains: Grains | None = None) -> DataFrame:
    """The category with the most revenue, if its margin lies below the plain mean of categories."""
    sums = _by_attribute(star, grains, "product", "category", "revenue", "profit").select(
        "category", "revenue", pct(F.col("profit"), F.col("revenue")).alias("margin_pct"))
    everything = (Window.orderBy(F.desc_nulls_first("revenue"), "category")
                  .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = sums.select(
        "*", F.row_number().over(Window.orderBy(F.desc_nulls_first("revenue"), "category"))
        .alias("place"),
        F.sum(F.col("margin_pct").cast("decimal(24,2)")).over(everything).alias("margins"),
        F.count("margin_pct").over(everything).alias("categories"))
    rows = ranked.where((F.col("place") == 1)
                        & (F.col("margin_pct") * F.col("categories") < F.col("margins")))
    return _insight(rows, 3, "Product", F.col("margin_pct"), F.col("category"),
                    " has the highest revenue but a below-average profit margin of ",
                    F.col("margin_pct").cast("decimal(20,2)").cast("string"), "% versus a ",
                    _one(per(F.col("margins"), F.col("categories"), 1)), "% average across categories.")


def churn_share(star: Star) -> DataFrame:
    high = F.count_if(F.col("risk_level") == "High").cast("decimal(20,0)")
    rows = star.churn.agg(pct(high, F.count(F.lit(1)), 1).alias("share")).where(
        F.col("share").isNotNull())
    return _insight(rows, 4, "Customer", F.col("share"), _one(F.col("share")),
                    "% of customers are classified as high churn risk based on the churn "
                    "prediction model.")


def top_customer_share(star: Star, grains: Grains | None = None, n: int = 10) -> DataFrame:
    """The top ten's part comes from a top-k, the whole from a sum; both are one row."""
    customers = _of(star, grains, "customer", "revenue")
    top = (customers.orderBy(F.desc_nulls_last("revenue"), "customer_id").limit(n)
           .agg(F.sum("revenue").alias("part"), F.lit(None).cast("decimal(34,2)").alias("whole")))
    whole = customers.agg(F.lit(None).cast("decimal(34,2)").alias("part"),
                          F.sum("revenue").alias("whole"))
    rows = (top.unionByName(whole)
            .agg(pct(F.sum("part").cast("decimal(24,2)"), F.sum("whole").cast("decimal(24,2)"), 1)
                 .alias("share"))
            .where(F.col("share").isNotNull()))
    return _insight(rows, 5, "Customer", F.col("share"), "The top 10 customers contribute ",
                    _one(F.col("share")), "% of total revenue.")


def discount_effect(star: Star, grains: Grains | None = None) -> DataFrame:
    margin = order_margin().cast("double")
    means = grains.margins() if grains is not None else sold(star.orders).where("revenue > 0").agg(
        *[F.avg(F.when(_discount_class() == c, margin)).alias(c) for c in ("high", "low")])
    rows = means.select(*[F.round(F.col(c) * 100, 2).cast("decimal(20,2)").alias(c) for c in ("high", "low")])
    rows = rows.withColumn("diff", F.round(F.col("low") - F.col("high"), 1)).where("diff > 0")
    return _insight(rows, 6, "Pricing", F.col("diff"),
                    "Orders discounted above 15% carry an average margin of ",
                    F.col("high").cast("string"), "%, ", _one(F.col("diff")),
                    " percentage points lower than orders discounted 15% or less.")


def targets_met(star: Star, grains: Grains | None = None) -> DataFrame:
    """Revenue of all years against the annual target."""
    actual = _of(star, grains, "salesperson", "revenue")
    reached = pct(F.coalesce(F.col("revenue"), F.lit(0)), F.col("target_amount")) >= 100
    rows = (star.employees.select("employee_id", "target_amount")
            .join(actual, "employee_id", "left")
            .agg(pct(F.count_if(reached).cast("decimal(20,0)"), F.count(F.lit(1)), 1)
                 .alias("share")).where(F.col("share").isNotNull()))
    return _insight(rows, 7, "Sales", F.col("share"), _one(F.col("share")),
                    "% of salespeople are meeting or exceeding their annual sales target.")


def most_returned_name(star: Star, grains: Grains | None = None, more_than: int = 20) -> DataFrame:
    """By product name, over all orders."""
    sums = grains.all_orders("product") if grains else by_key(star.orders, ["product_id"], "orders")
    returned = returns_by(star.orders, star.returns, "product_id")
    rows = (sums.join(returned, "product_id", "left")
            .join(star.products.select("product_id", "product_name"), "product_id")
            .groupBy("product_name")
            .agg(F.sum("orders").alias("ordered"),
                 F.coalesce(F.sum("return_count"), F.lit(0)).cast("decimal(20,0)")
                 .alias("returned"))
            .where(F.col("ordered") > more_than)
            .where("returned > 0")
            .orderBy(F.desc(F.col("returned") / F.col("ordered")), "product_name").limit(1)
            .select("product_name", pct(F.col("returned"), F.col("ordered"), 1).alias("rate")))
    return _insight(rows, 8, "Product", F.col("rate"), F.col("product_name"),
                    " has the highest return rate at ", _one(F.col("rate")),
                    "% among frequently ordered products.")


def all_insights(star: Star) -> DataFrame:
    grains = Grains(star)
    parts = [revenue_change(star, grains), leading_region(star, grains),
             thin_margin_category(star, grains)]
    if star.churn is not None:
        parts.append(churn_share(star))
    parts += [top_customer_share(star, grains), discount_effect(star, grains), targets_met(star, grains),
              most_returned_name(star, grains)]
    return reduce(DataFrame.unionByName, parts)
