"""Calendar columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

FISCAL_YEAR_STARTS_IN = 4


def month_of(column: str | Column) -> Column:
    return F.trunc(F.col(column) if isinstance(column, str) else column, "MM")


def as_of_column(as_of: dt.date | str | Column | None) -> Column:
    """The day a report is drawn up for; today unless the caller pins it."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def month_label(column: str) -> Column:
    return F.date_format(F.col(column), "MMM yyyy")


def calendar_columns(day: str = "date") -> list[Column]:
    d = F.col(day)
    return [
        d.alias("date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.weekofyear(d).alias("week"),
        F.date_format(d, "EEEE").alias("weekday"),
        F.when(F.month(d) >= FISCAL_YEAR_STARTS_IN, F.year(d) + 1).otherwise(F.year(d))
        .alias("fiscal_year"),
    ]


def calendar_between(bounds: DataFrame, first: str = "first_day", last: str = "last_day"
                     ) -> DataFrame:
    """One row per day for each (first, last) row of ``bounds``, with its calendar columns."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("date"))
    return days.select(*calendar_columns())


def order_calendar(orders: DataFrame) -> DataFrame:
    """The date dimension that covers every order date."""
    return calendar_between(
        orders.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
        .where(F.col("first_day").isNotNull()))
