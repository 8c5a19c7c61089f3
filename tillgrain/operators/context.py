"""Grouping columns and what they reach: which table owns a column, and which tables it narrows.

A dimension narrows the orders that point to it, and itself, and nothing else: grouping by a product's
category splits revenue, while the number of customers stays the same in every category. Sums are
taken over the orders at the grain of the keys that are needed, and dimensions are met there, so no
row of the fact is joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.functions.dates import month_of
from tillgrain.model import SCHEMAS
from tillgrain.operators.rollup import SUMS
from tillgrain.operators.scope import Filters, where_all
from tillgrain.sources.star import Star

# The key by which orders point to each dimension. A column that several own belongs to the first,
# unless its name says otherwise, as in employees.region.
KEYS = {"customers": "customer_id", "products": "product_id", "employees": "employee_id",
        "date_dimension": "order_date"}


class UnknownColumn(ValueError):
    """No table of the star owns a grouping column."""


@dataclass(frozen=True)
class Grouping:
    """A column to group by: its owner, its name there, and its name in the result."""

    table: str
    column: str
    name: str


def resolved(by: list[str] | None) -> list[Grouping]:
    """The grouping columns with their owners; ``table.column`` names an owner and becomes
    ``table_column``. A key belongs to its dimension."""
    found = []
    for text in by or []:
        table, dot, column = text.rpartition(".")
        owners = [table] if dot else [t for t in (*KEYS, "orders") if column in SCHEMAS[t].names]
        if not owners or owners[0] not in (*KEYS, "orders") or column not in SCHEMAS[owners[0]].names:
            raise UnknownColumn(f"no table of the star owns {text}")
        found.append(Grouping(owners[0], column, text.replace(".", "_")))
    return found


def _conditions(filters: Filters) -> dict[str, list[Column]]:
    return {"customers": filters.on_customers(), "products": filters.on_products(),
            "employees": filters.on_employees(), "date_dimension": []}


def dimension(star: Star, table: str, groups: list[Grouping], filters: Filters) -> DataFrame:
    """A dimension's key and its grouping columns, under the filter."""
    key = "date" if table == "date_dimension" else KEYS[table]
    return where_all(getattr(star, table), _conditions(filters)[table]).select(
        F.col(key).alias(KEYS[table]), *[F.col(g.column).alias(f"_{g.name}") for g in groups])


def merged(names: list[str]) -> list[Column]:
    """Sums of partial sums, in the types of single ones; bit sets are united."""
    def one(name: str) -> Column:
        if name.startswith("bits"):
            return F.bit_or(name)
        return F.sum(name).cast(SUMS[name]) if name in SUMS else F.sum(name)
    return [one(n).alias(n) for n in names]


def fact_sums(star: Star, by: list[str] | None, filters: Filters | None, sums: dict[str, Column],
              grain: dict[str, Column] | None = None, kept: list[str] | None = None) -> DataFrame:
    """Sums over the orders that count, per grouping column, per column of ``grain`` (computed from
    the orders), and per order column in ``kept``. Names of sums that begin with ``bits`` are bit sets."""
    filters, grain, kept = filters or Filters(), grain or {}, kept or []
    groups = resolved(by)
    conditions = _conditions(filters)
    used = [t for t in KEYS if conditions[t] or any(
        g.table == t and g.column != KEYS[t] for g in groups)]
    own = [g for g in groups if g.table not in used]
    orders = where_all(star.orders, filters.on_orders(star.orders.columns))
    keys = list(dict.fromkeys([*[KEYS[t] for t in used], *kept]))
    partial = (orders.select("*", *[F.col(_order_column(g)).alias(f"_{g.name}") for g in own])
               .groupBy(*keys, *[f"_{g.name}" for g in own], *[c.alias(n) for n, c in grain.items()])
               .agg(*[c.alias(n) for n, c in sums.items()]))
    for table in used:
        own_groups = [g for g in groups if g.table == table]
        side = dimension(star, table, own_groups, filters)
        partial = (partial.join(side, KEYS[table]) if own_groups
                   else partial.join(side, KEYS[table], "left_semi"))
    names = [F.col(f"_{g.name}").alias(g.name) for g in groups]
    kept = [k for k in kept if k not in {g.name for g in groups}]
    return partial.groupBy(*names, *kept, *grain).agg(*merged(list(sums)))


def _order_column(group: Grouping) -> str:
    return KEYS[group.table] if group.table in KEYS else group.column


def member_counts(star: Star, table: str, by: list[str] | None, filters: Filters | None, name: str
                  ) -> DataFrame:
    """Rows of a dimension per grouping column. Columns of other tables don't narrow it: each of
    their values, alone or in a combination that occurs, sees the same rows."""
    filters, groups = filters or Filters(), resolved(by)
    inner = [g for g in groups if g.table == table]
    counts = (dimension(star, table, inner, filters).groupBy(*[f"_{g.name}" for g in inner])
              .agg(F.count(F.lit(1)).alias(name)))
    outer: dict[str, list[Grouping]] = {}
    for g in groups:
        if g.table != table:
            outer.setdefault(g.table, []).append(g)
    sides = []
    for other, own in outer.items():
        values = (dimension(star, other, own, filters) if other in KEYS else star.orders.select(
            *[F.col(g.column).alias(f"_{g.name}") for g in own]))
        sides.append(values.select(*[f"_{g.name}" for g in own]).distinct())
    # The rows of this product are the rows of the result: every value beside every other.
    result = reduce(lambda a, b: a.crossJoin(b), [counts, *sides])
    return result.select(*[F.col(f"_{g.name}").alias(g.name) for g in groups], name)


# ---- periods

GRAINS = {"month": "MM", "quarter": "QUARTER", "year": "YEAR"}


def shifted_calendar(star: Star, back: int, grain: str) -> DataFrame:
    """The months of the calendar: ``month``, the ``period`` it lies in, and the month ``back`` months
    earlier, whose sales stand for it in a comparison."""
    months = star.date_dimension.select(month_of("date").alias("month")).distinct()
    return months.select("month", F.trunc("month", GRAINS[grain]).alias("period"),
                         F.add_months("month", -back).alias("earlier"))
