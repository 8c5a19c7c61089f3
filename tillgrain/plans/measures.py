"""Report measures, evaluated per group under a filter. Their division yields zero, not null.

Any column of the star can group: ``operators/context.py`` finds the table that owns it and what it
narrows. Sums are taken at key grain before a dimension is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.functions.dates import month_label, month_of
from tillgrain.functions.labels import margin_band
from tillgrain.functions.ratios import or_zero, pct, per
from tillgrain.operators.context import (
    GRAINS, fact_sums, member_counts, merged, resolved, shifted_calendar)
from tillgrain.operators.scope import Filters, scoped_orders, where_all
from tillgrain.sources.star import Star

PLACES = 6
#: Months in one word of a customer's bits; the bit below them repeats the last month of the word before.
WORD_MONTHS = 62


def _measures() -> dict[str, tuple[dict[str, Column], Column]]:
    """Per measure the sums that it needs, and what it makes of them."""
    revenue, profit, orders = ({"revenue": F.sum("revenue")}, {"profit": F.sum("profit")},
                               {"orders": F.count(F.lit(1))})
    return {
        "total_revenue": (revenue, F.col("revenue")),
        "total_profit": (profit, F.col("profit")),
        "profit_margin_pct": (revenue | profit,
                              or_zero(pct(F.col("profit"), F.col("revenue"), PLACES))),
        "total_orders": (orders, F.col("orders")),
        "average_order_value": (revenue | orders,
                                or_zero(per(F.col("revenue"), F.col("orders"), PLACES))),
    }


def _names(by: list[str] | None) -> list[str]:
    return [g.name for g in resolved(by)]


def measure(star: Star, name: str, by: list[str] | None = None, filters: Filters | None = None
            ) -> DataFrame:
    """A measure of order rows per group of ``by``."""
    sums, value = _measures()[name]
    return fact_sums(star, by, filters, sums).select(*_names(by), value.alias(name))


def total_customers(star: Star, by: list[str] | None = None, filters: Filters | None = None
                    ) -> DataFrame:
    """Customers of the dimension, buyers or not. customer_id is its key, so rows are customers.
    Columns of other tables don't narrow them."""
    return member_counts(star, "customers", by, filters, "total_customers")


def _listed(star: Star, filters: Filters | None) -> DataFrame:
    return where_all(star.customers, (filters or Filters()).on_customers())


# ---- measures that look at another period

def _with_earlier(star: Star, back: int, name: str, by: list[str] | None, filters: Filters | None,
                  grain: str) -> DataFrame:
    """Each period of the calendar beside the revenue of its months moved ``back`` months. A group has a
    row for every period in which one of the two exists; the other one is then null. The
    two meet by grouping, so that a group without a name meets itself as well. Months with sales that
    the calendar lacks stand for themselves."""
    names = _names(by)
    if grain in names:
        raise ValueError(f"{grain} is the grain and can't be a grouping column as well")
    months = fact_sums(star, by, filters, {"revenue": F.sum("revenue")},
                       {"month": month_of("order_date")})
    nothing = F.lit(None).cast("decimal(24,2)")
    known = shifted_calendar(star, back, grain)
    sold_in = months.select("month").distinct()
    missing = sold_in.join(known, "month", "left_anti").select(
        "month", F.trunc("month", GRAINS[grain]).alias("period"),
        F.add_months("month", -back).alias("earlier"))
    calendar = known.unionByName(missing)
    now = months.join(calendar, "month").select(*names, "period", "revenue", nothing.alias(name))
    before = months.withColumnRenamed("month", "earlier").join(calendar, "earlier").select(
        *names, "period", nothing.alias("revenue"), F.col("revenue").alias(name))
    return (now.unionByName(before).groupBy(*names, F.col("period").alias(grain))
            .agg(*[F.sum(c).cast("decimal(24,2)").alias(c) for c in ("revenue", name)])
            .orderBy(*names, grain))


def year_ago_revenue(star: Star, by: list[str] | None = None, filters: Filters | None = None,
                     grain: str = "month") -> DataFrame:
    return _with_earlier(star, 12, "yoy_revenue", by, filters, grain)


def year_on_year_growth(star: Star, by: list[str] | None = None, filters: Filters | None = None,
                        grain: str = "month") -> DataFrame:
    prior = F.col("yoy_revenue")
    growth = or_zero(pct(or_zero(F.col("revenue")) - prior, prior, PLACES))
    return year_ago_revenue(star, by, filters, grain).select(*_names(by), grain,
                                                             growth.alias("revenue_growth_yoy"))


def month_ago_revenue(star: Star, by: list[str] | None = None, filters: Filters | None = None,
                      grain: str = "month") -> DataFrame:
    """The revenue of each period's months moved by one month. A gap gives null; it does not reach
    further back."""
    return _with_earlier(star, 1, "mom_revenue", by, filters, grain)


def customer_retention(star: Star, by: list[str] | None = None, filters: Filters | None = None
                       ) -> DataFrame:
    """Per month: buyers who also bought the month before, over all buyers.

    A customer's months are bits of a few words, united by partial aggregation, so a customer with very
    many orders costs a row per task. A month is retained where the bit below it is set too; a word's
    last month is repeated as the lowest bit of the next word.
    """
    names = _names(by)
    each = list(dict.fromkeys([*names, "customer_id"]))
    day = F.col("order_date")
    month = F.year(day) * 12 + F.month(day) - 1
    word, place = F.floor(month / WORD_MONTHS), (month % WORD_MONTHS).cast("int")
    one = F.lit(1).cast("long")
    bit = F.call_function("shiftleft", one, place + 1)
    bits = fact_sums(star, by, filters, {"bits": F.bit_or(bit)}, {"word": word}, ["customer_id"])
    last = F.col("bits").bitwiseAND(F.lit(1 << WORD_MONTHS)) != 0
    # Bits of one customer lie in few rows: the carried ones join them by another union of bits.
    carried = bits.where(last).select(*each, (F.col("word") + 1).alias("word"),
                                      one.alias("bits"))
    whole = bits.unionByName(carried).groupBy(*each, "word").agg(*merged(["bits"]))
    stayed = F.col("bits").bitwiseAND(F.call_function("shiftleft", F.col("bits"), F.lit(1)))
    on = lambda b, p: F.call_function("shiftright", b, p).bitwiseAND(one) == 1
    places = F.filter(F.sequence(F.lit(1), F.lit(WORD_MONTHS)), lambda p: on(F.col("bits"), p))
    unfolded = (whole.withColumn("_stayed", stayed).withColumn("_place", F.explode(places))
                .withColumn("_index", F.col("word") * WORD_MONTHS + F.col("_place") - 1))
    month_of_index = F.make_date(F.floor(F.col("_index") / 12).cast("int"),
                                 (F.col("_index") % 12 + 1).cast("int"), F.lit(1))
    share = or_zero(pct(F.count_if(on(F.col("_stayed"), F.col("_place"))), F.count(F.lit(1)), PLACES))
    return (unfolded.groupBy(*names, month_of_index.alias("month"))
            .agg(share.alias("customer_retention_pct")).orderBy(*names, "month"))


# ---- measures over other tables

def target_achievement(star: Star, by: list[str] | None = None, filters: Filters | None = None
                       ) -> DataFrame:
    """Revenue over all targets per group of salespeople, zero without targets. Both are summed per
    salesperson before they meet."""
    by = ["employee_id"] if by is None else by
    filters = filters or Filters()
    planned = star.targets.groupBy("employee_id").agg(F.sum("target_amount").alias("planned"))
    actual = (scoped_orders(star, filters).groupBy("employee_id")
              .agg(F.sum("revenue").alias("revenue")))
    staff = where_all(star.employees, filters.on_employees()).select(
        *dict.fromkeys(["employee_id", *by]))
    share = or_zero(pct(F.sum("revenue"), F.sum("planned"), PLACES))
    return (staff.join(planned, "employee_id", "left").join(actual, "employee_id", "left")
            .groupBy(*by).agg(share.alias("target_achievement_pct")))


def customer_churn(star: Star, by: list[str] | None = None, filters: Filters | None = None
                   ) -> DataFrame:
    """Predicted leavers over all predictions, per group of customer attributes."""
    lost = F.count_if(F.col("churn_prediction") == 1)
    share = or_zero(pct(lost, F.count(F.lit(1)), PLACES))
    scores = star.churn
    if by or (filters and filters.on_customers()):
        scores = scores.join(_listed(star, filters).select(
            *dict.fromkeys(["customer_id", *(by or [])])), "customer_id")
    return scores.groupBy(*(by or [])).agg(share.alias("customer_churn_pct"))


def revenue_per_customer(star: Star, by: list[str] | None = None, filters: Filters | None = None
                         ) -> DataFrame:
    """Revenue over the customers of the dimension, buyers or not. Columns of other tables split the
    revenue and leave the customers whole."""
    names = _names(by)
    count = total_customers(star, by, filters)
    bought = fact_sums(star, by, filters, {"revenue": F.sum("revenue")}).select(
        *[F.col(n).alias(f"_{n}") for n in names], "revenue")
    share = or_zero(per(F.col("revenue"), F.col("total_customers"), PLACES))
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_{n}"))
    return count.join(bought, same, "left").select(*names, share.alias("revenue_per_customer"))


def with_order_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_month_label", month_label("order_date"))


def with_margin_band(products: DataFrame) -> DataFrame:
    return products.withColumn("margin_band", margin_band(F.col("selling_price"),
                                                          F.col("unit_cost")))
