"""Filters shared by all reports, search, and pages."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.functions.ratios import counts_as_revenue
from tillgrain.operators.ordering import with_row_number
from tillgrain.sources.star import Star

MAX_PAGE_SIZE = 200


def _day(value: dt.date | str | None) -> dt.date | None:
    return dt.date.fromisoformat(value) if isinstance(value, str) and value else value or None


@dataclass(frozen=True)
class Filters:
    """What a report is narrowed to; an empty value narrows nothing. Dates include both ends."""

    date_from: dt.date | str | None = None
    date_to: dt.date | str | None = None
    region: str | None = None
    category: str | None = None
    customer_segment: str | None = None
    salesperson: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "date_from", _day(self.date_from))
        object.__setattr__(self, "date_to", _day(self.date_to))
        if self.date_from and self.date_to and self.date_to < self.date_from:
            raise ValueError("date_to must not lie before date_from")

    def on_customers(self) -> list[Column]:
        wanted = {"region": self.region, "customer_segment": self.customer_segment}
        return [F.col(c) == v for c, v in wanted.items() if v]

    def on_products(self) -> list[Column]:
        return [F.col("category") == self.category] if self.category else []

    def on_employees(self) -> list[Column]:
        return [F.col("employee_name") == self.salesperson] if self.salesperson else []

    def on_orders(self, columns: list[str]) -> list[Column]:
        conditions = [counts_as_revenue()]
        if self.date_from:
            conditions.append(F.col("order_date") >= F.lit(self.date_from))
        if self.date_to:
            conditions.append(F.col("order_date") <= F.lit(self.date_to))
        if "order_month" in columns:  # the stored fact's partition column
            if self.date_from:
                conditions.append(F.col("order_month") >= F.lit(self.date_from.replace(day=1)))
            if self.date_to:
                conditions.append(F.col("order_month") <= F.lit(self.date_to))
        return conditions


def where_all(df: DataFrame, conditions: list[Column]) -> DataFrame:
    for condition in conditions:
        df = df.where(condition)
    return df


def scoped_orders(star: Star, filters: Filters | None = None) -> DataFrame:
    """The order rows a filtered report reads.

    A dimension takes part only if the filter names one of its columns, as a semi-join on its key;
    cleaning has already removed orders that point nowhere.
    """
    filters = filters or Filters()
    orders = where_all(star.orders, filters.on_orders(star.orders.columns))
    for table, key, conditions in (("customers", "customer_id", filters.on_customers()),
                                   ("products", "product_id", filters.on_products()),
                                   ("employees", "employee_id", filters.on_employees())):
        if conditions:
            wanted = where_all(getattr(star, table), conditions).select(key)
            orders = orders.join(wanted, key, "left_semi")
    return orders


# Which attributes enriched_orders takes from which dimension.
_ATTRIBUTES = {
    "customers": ("customer_id", ["customer_name", "region", "customer_segment",
                                  "customer_status", "acquisition_date"]),
    "products": ("product_id", ["product_name", "category", "sub_category", "unit_cost",
                                "selling_price"]),
    "employees": ("employee_id", ["employee_name", "department"]),
}


def enriched_orders(star: Star, filters: Filters | None = None,
                    columns: list[str] | None = None) -> DataFrame:
    """Order rows with the dimension attributes asked for; only the dimensions that own one of
    ``columns`` are joined."""
    orders = scoped_orders(star, filters)
    wanted = columns or [*orders.columns,
                         *[a for _, names in _ATTRIBUTES.values() for a in names]]
    for table, (key, names) in _ATTRIBUTES.items():
        used = [n for n in names if n in wanted]
        if used:
            orders = orders.join(getattr(star, table).select(key, *used), key)
    return orders.select(*wanted)


def matches(term: str, *columns: str) -> Column:
    """Case-insensitive substring search; % and _ in the term keep their wildcard meaning."""
    found = F.lit(False)
    for column in columns:
        found = found | F.col(column).cast("string").ilike(f"%{term}%")
    return found


def equals_if_given(df: DataFrame, column: str, value: str | None) -> DataFrame:
    return df.where(F.col(column) == value) if value else df


def check_page(page: int, page_size: int) -> None:
    if page < 1:
        raise ValueError("page must be 1 or more")
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must lie between 1 and {MAX_PAGE_SIZE}")


@dataclass(frozen=True)
class Order:
    """A column that a page is ordered by. Descending puts nulls first, ascending too."""

    column: str
    descending: bool = False

    def sort(self) -> Column:
        return F.desc_nulls_first(self.column) if self.descending else F.asc_nulls_first(self.column)

    def after(self, value: object) -> Column:
        """Whether a row comes after the value in this column."""
        if value is None:  # nulls come first
            return F.col(self.column).isNotNull()
        later = F.col(self.column) < F.lit(value) if self.descending else F.col(self.column) > F.lit(value)
        return F.coalesce(later, F.lit(False))


def page_after(df: DataFrame, order: list[Order], last: dict | None = None, page_size: int = 25
               ) -> DataFrame:
    """The page that follows the row ``last`` (its values of the order's columns), or the first one.

    The order ends in a key. The rows before are filtered away, so a page far back costs as much as
    the first: a task hands on its first ``page_size`` rows at most, and no row is numbered."""
    check_page(1, page_size)
    if last is not None:
        beyond, same = F.lit(False), F.lit(True)
        for part in order:
            beyond = beyond | (same & part.after(last[part.column]))
            same = same & F.col(part.column).eqNullSafe(F.lit(last[part.column]))
        df = df.where(beyond)
    return df.orderBy(*[part.sort() for part in order]).limit(page_size)


def page_of(df: DataFrame, order: list[Column], page: int = 1, page_size: int = 25) -> DataFrame:
    """One page by its number. The order should end in a key, or rows could move between pages.

    The first page is a limit; later ones are cut out by row numbers, since a limit would gather all
    rows up to the page in one place. ``page_after`` needs neither.
    """
    check_page(page, page_size)
    if page == 1:
        return df.orderBy(*order).limit(page_size)
    skipped = (page - 1) * page_size
    numbered = with_row_number(df, order, "_rn")
    return (numbered.where(F.col("_rn").between(skipped + 1, skipped + page_size))
            .orderBy("_rn").drop("_rn"))


def page_info(df: DataFrame, page: int = 1, page_size: int = 25) -> DataFrame:
    check_page(page, page_size)
    total = F.count(F.lit(1))
    return df.agg(
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        total.alias("total_rows"),
        F.greatest(F.lit(1), F.ceil(total / page_size)).cast("int").alias("page_count"))
