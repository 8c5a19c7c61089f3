"""Delivered CSV files, read by column name with declared types and a row sequence."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillgrain.model import SOURCE_TABLES, UNFIT, as_delivered

# Columns that together put delivered rows in file order. Within one split the increasing id
# follows the lines; the block start orders the splits of a file, and the path orders the files.
SEQUENCE = ("_file", "_block", "_line")
# The text of a record with too few or too many fields.
BROKEN = "_broken"


# Texts that stand for a missing value in a delivered file.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
           "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


class MissingSource(FileNotFoundError):
    """A required source file is not there."""


class MissingColumn(ValueError):
    """A source file lacks a required column."""


# Numbers of a table whose rules look at amounts are read in this type, so that a value that its
# column can't store is judged as it is.
WIDE = T.DecimalType(38, 12)
JUDGED = ("orders",)


class UnfitValue(ValueError):
    """A delivered number passed the rules and can't be stored in its column."""


class BrokenRecords(ValueError):
    """Delivered records have too few or too many fields."""


def _typed(column: str, kind: T.DataType, wide: bool = False) -> Column:
    """The text as a value of its type; a text that is none becomes null and counts as missing."""
    text = F.when(~F.col(column).isin(*MISSING), F.col(column))
    if wide and isinstance(kind, (T.IntegerType, T.DecimalType)):
        return text.try_cast(WIDE).alias(column)
    if isinstance(kind, T.IntegerType):
        number = text.try_cast("decimal(20,4)")
        return F.when(number == F.floor(number), number.try_cast("int")).alias(column)
    return text.try_cast(kind).alias(column)


def to_stored_places(df: DataFrame, table: str) -> DataFrame:
    """Wide numbers, rounded to the places of the columns that will store them."""
    kinds = {f.name: f.dataType for f in as_delivered(table).fields}
    return df.select(*[
        F.round(c, kinds[c].scale).cast(WIDE).alias(c)
        if isinstance(kinds.get(c), T.DecimalType) else F.col(c) for c in df.columns])


def _stored(column: str, kind: T.DataType) -> Column:
    value = F.col(column)
    if isinstance(kind, T.IntegerType):
        return F.when(value == F.floor(value), value.try_cast(kind))
    return value.try_cast(kind)


def narrowed(df: DataFrame, table: str) -> DataFrame:
    """Wide numbers in the types of their columns. A row with one that doesn't fit gets null there and
    all its wide numbers in a column of their own, which other rows leave null."""
    kinds = {f.name: f.dataType for f in as_delivered(table).fields}
    numbers = [c for c in df.columns if isinstance(kinds[c], (T.IntegerType, T.DecimalType))]
    made = {c: _stored(c, kinds[c]) for c in numbers}
    unfit = F.lit(False)
    for c in numbers:
        unfit = unfit | (F.col(c).isNotNull() & made[c].isNull())
    return df.select(*[made[c].alias(c) if c in made else F.col(c) for c in df.columns],
                     F.when(unfit, F.struct(*numbers)).alias(UNFIT))


def as_judged(df: DataFrame) -> DataFrame:
    """The rows of ``narrowed`` with their wide numbers."""
    wide = [f.name for f in df.schema[UNFIT].dataType.fields]
    return df.select(*[F.coalesce(F.col(f"{UNFIT}.{c}"), F.col(c).cast(WIDE)).alias(c) if c in wide
                       else F.col(c) for c in df.columns if c != UNFIT])


def fits(df: DataFrame) -> dict[str, Column]:
    """For each number of ``narrowed`` rows, whether its column can store it."""
    wide = [f.name for f in df.schema[UNFIT].dataType.fields]
    return {c: F.col(f"{UNFIT}.{c}").isNull() | F.col(c).isNotNull() for c in wide}


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line))


def read_delivered(spark: SparkSession, folder: str, table: str,
                   multi_line: bool = False, wide: bool = False, broken: bool = False) -> DataFrame:
    """The file's columns, found by their names in the header, and the row sequence. A quote inside a
    quoted value is doubled. Files with line breaks inside of quotes need ``multi_line``; such a file
    is read by one task. ``wide`` numbers have room for values that their columns can't store.
    ``broken`` adds the text of each record that has too few or too many fields, null for the others."""
    path = f"{folder.rstrip('/')}/{table}.csv"
    try:
        names = _reader(spark, multi_line).csv(path).columns
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise MissingSource(f"required source file is missing: {path}") from error
        raise
    schema = as_delivered(table)
    lacking = sorted(set(schema.names) - set(names))
    if lacking:
        raise MissingColumn(f"{path} lacks the columns {lacking}")
    # Fields are counted only if all are parsed. Headers of further files must agree with the first.
    rows = (_reader(spark, multi_line).schema(T.StructType(
        [T.StructField(n, T.StringType()) for n in (*names, BROKEN)]))
        .option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False)
        .option("enforceSchema", False).csv(path))
    return rows.select(*[_typed(f.name, f.dataType, wide) for f in schema.fields],
                       F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_line"), *([BROKEN] if broken else []))


def read_all_delivered(spark: SparkSession, folder: str,
                       multi_line: bool = False, wide: bool = False, broken: bool = False
                       ) -> dict[str, DataFrame]:
    """All files; ``wide`` holds for the tables that rules look into for amounts."""
    return {table: read_delivered(spark, folder, table, multi_line, wide and table in JUDGED, broken)
            for table in SOURCE_TABLES}


def export_csv(df: DataFrame, path: str) -> None:
    """Write a whole report block for a spreadsheet: every value quoted, null as empty."""
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("escape", '"').option("nullValue", "").option("emptyValue", "").csv(path))
