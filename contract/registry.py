"""Named checks: a Spark query and, where SQL can say it, the same in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from tillgrain.sources.linestar import star_from_lines
from tillgrain.sources.star import Star

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type both engines hand over alike."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def raw_case(key: str, run: Query, oracle: str | None = None) -> None:
    if key in QUERIES:
        raise ValueError(f"duplicate key {key}")
    QUERIES[key] = lambda spark, folder: plain(run(spark, folder))
    if oracle is not None:
        ORACLES[key] = oracle


def case(key: str, run: Callable[[Star], DataFrame], oracle: str | None = None) -> None:
    """A query over the star mapped from the folder's tables."""
    raw_case(key, lambda spark, folder: run(star_from_lines(spark, folder)), oracle)


def digest(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a table, and a sum over them that depends on every value of the columns."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in columns]
    part = F.conv(F.substring(F.md5(F.concat_ws("|", *cells).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                  F.coalesce(F.sum(part), F.lit(0)).alias("digest"))
