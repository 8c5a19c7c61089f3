"""The tables every report reads, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from typing import Union

from pyspark.sql import DataFrame

Source = Union[DataFrame, Callable[[], DataFrame]]

TABLES = ("date_dimension", "customers", "products", "employees", "orders", "returns", "targets")


class Star:
    """Tables by name. A table given as a function is opened when a report first asks for it, so a
    report opens only the files it reads. ``churn`` holds the churn predictions, ``scores`` the stored
    RFM scores, and ``history`` the orders that count with their returns, if there are any.
    """

    def __init__(self, *, churn: Source | None = None, scores: Source | None = None,
                 history: Source | None = None, **tables: Source) -> None:
        missing = set(TABLES) - set(tables)
        if missing:
            raise ValueError(f"the star lacks {sorted(missing)}")
        self._sources = {**{t: tables[t] for t in TABLES}, "churn": churn,
                         "scores": scores, "history": history}

    def _open(self, name: str) -> DataFrame | None:
        source = self._sources[name]
        if source is not None and not isinstance(source, DataFrame):
            source = self._sources[name] = source()
        return source

    @property
    def orders(self) -> DataFrame:
        return self._open("orders")

    @property
    def customers(self) -> DataFrame:
        return self._open("customers")

    @property
    def products(self) -> DataFrame:
        return self._open("products")

    @property
    def employees(self) -> DataFrame:
        return self._open("employees")

    @property
    def returns(self) -> DataFrame:
        return self._open("returns")

    @property
    def targets(self) -> DataFrame:
        return self._open("targets")

    @property
    def date_dimension(self) -> DataFrame:
        return self._open("date_dimension")

    @property
    def churn(self) -> DataFrame | None:
        return self._open("churn")

    @property
    def scores(self) -> DataFrame | None:
        return self._open("scores")

    @property
    def history(self) -> DataFrame | None:
        return self._open("history")

    def with_predictions(self, churn: Source) -> "Star":
        return Star(**{**self._sources, "churn": churn})

    def with_scores(self, scores: Source) -> "Star":
        return Star(**{**self._sources, "scores": scores})

    def with_history(self, history: Source) -> "Star":
        return Star(**{**self._sources, "history": history})

    def tables(self) -> dict[str, DataFrame]:
        named = {t: self._open(t) for t in TABLES}
        if self.churn is not None:
            named["customer_churn_predictions"] = self.churn
        return named
