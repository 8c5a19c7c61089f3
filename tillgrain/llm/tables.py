"""Reading the corpus tables and naming the queries over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function as the query of that name, with its SQL where SQL can say it."""
    def add(run: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return run
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text"):
    """The text, with null read as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def unused(name: str, rows: DataFrame) -> str:
    """A column name that the rows don't have, by Spark's rules: case makes no difference."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
