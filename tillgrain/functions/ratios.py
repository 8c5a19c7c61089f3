"""Ratios, means and the revenue rule, as Column builders.

Money stays decimal throughout. Quotients are rounded once, half away from zero, by integer division
of exact amounts, so neither the declared width of a sum nor the route it came by can change a digit.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

EXACT = "decimal(38,6)"  # holds sums of money, fractions and counts without loss


def counts_as_revenue() -> Column:
    """Everything but cancelled orders; returned orders stay in."""
    return F.col("order_status") != "Cancelled"


def _rounded_quotient(part: Column, whole: Column, factor: int, places: int) -> Column:
    """factor * part / whole with ``places`` digits; the doubled division rounds halves up."""
    p, w = part.cast(EXACT), F.nullif(whole.cast(EXACT), F.lit(0))
    doubled = F.abs(p) * F.lit(2 * factor * 10 ** places) + F.abs(w)
    units = F.call_function("div", doubled, F.abs(w) * F.lit(2)).cast("decimal(20,0)")
    signed = F.when((p < 0) != (w < 0), -units).otherwise(units)
    return (signed * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(26,{places})")


def pct(part: Column, whole: Column, places: int = 2) -> Column:
    """part / whole in percent, null where whole is zero or null."""
    return _rounded_quotient(part, whole, 100, places)


def growth_pct(current: Column, previous: Column, places: int = 2) -> Column:
    return pct(current - previous, previous, places)


def per(part: Column, whole: Column, places: int = 2) -> Column:
    """Plain quotient, null where whole is zero or null."""
    return _rounded_quotient(part, whole, 1, places)


def mean_of(column: str | Column, places: int = 2) -> Column:
    """Average, rounded once; ``avg`` would keep only four extra digits."""
    col = F.col(column) if isinstance(column, str) else column
    return per(F.sum(col), F.count(col), places)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
