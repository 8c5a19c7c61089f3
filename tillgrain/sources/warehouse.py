"""The loaded star on shared storage, and report files next to it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillgrain.functions.dates import month_of
from tillgrain.model import SOURCE_TABLES, UNFIT
from tillgrain.session import CODEC, shuffles_dropped
from tillgrain.sources.snapshots import Draft, current
from tillgrain.sources.star import Star

PREDICTIONS = "customer_churn_predictions"
SCORES = "rfm_scores"


class ReportNotBuilt(FileNotFoundError):
    """A report was asked for before the job that writes it has run."""


class TableNotLoaded(FileNotFoundError):
    """A table was asked for that no published load has written."""


def write_table(df: DataFrame, path: str, table: str) -> None:
    """One table's files. The fact is split by order month so that date filters skip files; the
    rebalance hint cuts a month that is much larger than others into several tasks."""
    if table == "orders":
        fact = df.withColumn("order_month", month_of("order_date"))
        fact.hint("rebalance", "order_month").write.option("compression", CODEC).partitionBy("order_month").parquet(path)
    else:
        df.write.option("compression", CODEC).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table's files, without the column that holds values which don't fit: what is published has
    none."""
    return spark.read.parquet(path).drop(UNFIT)


def store_all(tables: dict[str, DataFrame], folder: str) -> None:
    """Replace tables together: readers see all of them or none."""
    frames = list(tables.values())
    if not frames:
        return
    draft = Draft(frames[0].sparkSession, folder)
    try:
        with shuffles_dropped(frames[0].sparkSession):
            for table, df in tables.items():
                write_table(df, draft.path(table), table)
    except BaseException:
        draft.discard()
        raise
    draft.publish()


def store_table(df: DataFrame, folder: str, table: str) -> None:
    """Replace one table; the others stay as they are."""
    store_all({table: df}, folder)


def load_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    path = (current(spark, folder) or {}).get(table)
    if path is None:
        raise TableNotLoaded(f"{folder} has no published table {table}")
    return read_table(spark, path)


def open_star(spark: SparkSession, folder: str) -> Star:
    """The star as it is published now; each table is read when a report first asks for it, and a
    later load doesn't change what this star reads."""
    paths = current(spark, folder) or {}

    def opened(table: str):
        def read() -> DataFrame:
            if table not in paths:
                raise TableNotLoaded(f"{folder} has no published table {table}")
            return read_table(spark, paths[table])
        return read

    more = {name: opened(table) for name, table in (("churn", PREDICTIONS), ("scores", SCORES))
            if table in paths}
    return Star(**more, **{t: opened(t) for t in SOURCE_TABLES})


def loaded_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per stored table."""
    star = open_star(spark, folder)
    parts = [getattr(star, t).agg(F.lit(t).alias("table_name"),
                                  F.count(F.lit(1)).alias("row_count")) for t in SOURCE_TABLES]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def write_report(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def read_report(spark: SparkSession, folder: str, name: str, schema: str,
                built_by: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("header", True).csv(f"{folder}/{name}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise ReportNotBuilt(f"report '{name}' not found; run {built_by} first") from error
        raise
