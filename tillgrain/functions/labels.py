"""Fixed business labels: segments, tiers and bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def _first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    (cond, label), *rest = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], F.lit(rule[1])), rest,
                   F.when(cond, F.lit(label)))
    return chain.otherwise(F.lit(otherwise))


def rfm_segment(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    """The first rule that holds names the segment."""
    R, Q, M = F.col(r), F.col(f), F.col(m)
    # Segment names and score thresholds.
    return _first_match([
        ((R >= 4) & (Q >= 4) & (M >= 4), "Champions"),
        ((R >= 3) & (Q >= 3), "Loyal Customers"),
        ((R >= 4) & (Q <= 2), "New Customers"),
        ((R >= 3) & (Q <= 3) & (M >= 3), "Potential Loyalists"),
        ((R <= 2) & (Q >= 4) & (M >= 4), "Can't Lose Them"),
        ((R <= 2) & (Q >= 3), "At Risk"),
        ((R <= 2) & (Q <= 2) & (M <= 2), "Lost Customers"),
    ], "Hibernating")


# Scorecard tiers in display order.
PERFORMANCE_TIERS = ("Top Performer", "Strong Performer", "Average Performer",
                     "Needs Improvement", "No Data")


def performance_tier(pct: Column) -> Column:
    """Scorecard tier; a missing percentage has its own tier."""
    return _first_match([
        (pct.isNull(), "No Data"),
        (pct >= 110, "Top Performer"),
        (pct >= 90, "Strong Performer"),
        (pct >= 70, "Average Performer"),
    ], "Needs Improvement")


def attainment_tier(pct: Column) -> Column:
    """The sales page's tier: lower cut-offs, and a missing percentage counts as zero."""
    value = F.coalesce(pct, F.lit(0))
    return _first_match([
        (value >= 100, "Top Performer"),
        (value >= 80, "Strong Performer"),
        (value >= 60, "Average Performer"),
    ], "Needs Improvement")


def discount_band(discount: Column) -> Column:
    return _first_match([
        (discount == 0, "0%"),
        (discount <= F.lit("0.10").cast("decimal(5,4)"), "1-10%"),
        (discount <= F.lit("0.20").cast("decimal(5,4)"), "11-20%"),
    ], "20%+")


def margin_band(price: Column, cost: Column) -> Column:
    """Band of a product's list margin; a zero price counts as no margin."""
    margin = F.coalesce((price - cost) * 100 / F.nullif(price, F.lit(0)), F.lit(0))
    return _first_match([(margin >= 40, "High Margin"), (margin >= 20, "Medium Margin")],
                        "Low Margin")


def risk_level(probability: Column) -> Column:
    """Bands are closed on the right."""
    return _first_match([(probability <= 0.33, "Low"), (probability <= 0.66, "Medium")], "High")
