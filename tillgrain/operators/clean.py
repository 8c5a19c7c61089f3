"""Cleaning of delivered tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.model import PRICE, SOURCE_TABLES
from tillgrain.operators.keys import keep_first
from tillgrain.session import pin
from tillgrain.sources.flatfiles import SEQUENCE


class MixedDates(ValueError):
    """No date form fits all values of a column."""


# The forms a delivered date may have, the likelier reading of an ambiguous one first.
DATE_FORMS = ("ISO", "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy", "yyyyMMdd",
              "d MMM yyyy", "MMM d, yyyy", "d MMMM yyyy", "MMMM d, yyyy", "d-MMM-yyyy")
# The columns with dates of each delivered table.
DATES = {"date_dimension": "date", "customers": "acquisition_date", "employees": "joining_date",
         "orders": "order_date", "returns": "return_date"}


def as_date(text: Column, form: str) -> Column:
    """The text as a date of that form, null if it isn't one. The ISO form may have a time behind."""
    if form == "ISO":
        return text.try_cast("date")
    return F.try_to_timestamp(text, F.lit(form)).cast("date")


def form_counts(text: Column, rows: Column) -> list[Column]:
    """Aggregates over distinct texts, each found in ``rows`` rows, that tell which form fits a column:
    ``elected`` reads them. A column has few days, and a text that is no date costs an exception per form,
    so each text is tried once, not once per row."""
    def counted(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, rows)), F.lit(0))

    return [counted(text.isNotNull()).alias("texts"),
            *[counted(as_date(text, form).isNotNull()).alias(f"fit{i}") for i, form in enumerate(DATE_FORMS)],
            *[F.min(F.when(as_date(text, form).isNull(), text)).alias(f"odd{i}")
              for i, form in enumerate(DATE_FORMS)]]


def elected(counts, column: str) -> str:
    """The first form that fits all texts. Texts of several forms stop the job; the form that fits most
    of them is named, and a text that it doesn't fit."""
    fit = [counts[f"fit{i}"] for i in range(len(DATE_FORMS))]
    best = max(range(len(DATE_FORMS)), key=lambda i: (fit[i], -i))
    if fit[best] < counts["texts"]:
        raise MixedDates(f"{column} is not a date: {counts[f'odd{best}']}; {DATE_FORMS[best]} fits "
                         f"{fit[best]} of {counts['texts']} values, and no form fits all")
    return DATE_FORMS[best]


def date_form(df: DataFrame, column: str) -> str:
    """The form of a column's dates, by one aggregate over its distinct texts."""
    texts = df.groupBy(F.col(column).cast("string").alias("_text")).agg(F.count(F.lit(1)).alias("_rows"))
    return elected(texts.agg(*form_counts(F.col("_text"), F.col("_rows"))).first(), column)


def strict_date(column: str, form: str = "ISO") -> Column:
    """The text as a date; a text that is no date stops the job and names itself."""
    text = F.col(column).cast("string")
    parsed = as_date(text, form)
    return (F.when(text.isNull() | parsed.isNotNull(), parsed)
            .otherwise(F.raise_error(F.concat(F.lit(f"{column} is not a date: "), text))
                       .cast("date")))


def trimmed(column: str) -> Column:
    return F.trim(F.col(column))


def normal_email(column: str) -> Column:
    return F.trim(F.lower(F.col(column)))


def two_places(column: str) -> Column:
    return F.round(F.col(column).cast("decimal(20,6)"), 2).cast(PRICE)


def only_known(df: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Rows whose key exists in ``known``; a null key is never known."""
    return df.join(known.select(key), key, "left_semi").select(*df.columns)


def only_all_known(df: DataFrame, source: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Rows each of whose keys exists in its parent; ``source`` holds all their keys, and maybe more.

    One pass over the keys alone finds those that no parent knows. They are few beside the parents, and
    rows are only moved for them where they are too many to be sent to every task."""
    keys = list(parents)
    kinds = {f.name: f.dataType for f in source.schema.fields}
    sets = F.array(*[F.struct(*[(F.col(c) if c == key else F.lit(None)).cast(kinds[c]).alias(c) for c in keys])
                     for key in keys])
    found = pin(source.select(F.inline(sets)).distinct())
    rows = df
    for key in keys:
        lost = pin(found.select(key).where(F.col(key).isNotNull())
                   .join(parents[key].select(key), key, "left_anti"))
        rows = rows.where(F.col(key).isNotNull()).join(lost, key, "left_anti")
    return rows.select(*df.columns)


def sound_amounts(orders: DataFrame) -> DataFrame:
    """A null amount fails, too."""
    return orders.where((F.col("quantity") > 0) & (F.col("revenue") >= 0) & (F.col("cost") >= 0))


def with_profit(orders: DataFrame) -> DataFrame:
    return orders.withColumn(
        "profit", F.round(F.col("revenue") - F.col("cost"), 2).try_cast("decimal(14,2)"))


def clean_customers(raw: DataFrame, sequence: list[str], form: str = "ISO") -> DataFrame:
    return (keep_first(raw, ["customer_id"], sequence)
            .withColumn("acquisition_date", strict_date("acquisition_date", form))
            .withColumn("customer_name", trimmed("customer_name"))
            .withColumn("email", normal_email("email")))


def clean_products(raw: DataFrame, sequence: list[str]) -> DataFrame:
    return (keep_first(raw, ["product_id"], sequence)
            .withColumn("unit_cost", two_places("unit_cost"))
            .withColumn("selling_price", two_places("selling_price")))


def clean_employees(raw: DataFrame, sequence: list[str], form: str = "ISO") -> DataFrame:
    return (keep_first(raw, ["employee_id"], sequence)
            .withColumn("joining_date", strict_date("joining_date", form)))


def clean_orders(raw: DataFrame, customers: DataFrame, products: DataFrame,
                 employees: DataFrame, sequence: list[str], form: str = "ISO", first=keep_first
                 ) -> DataFrame:
    rows = (first(raw, ["order_id"], sequence)
            .withColumn("order_date", strict_date("order_date", form)))
    rows = only_all_known(rows, raw, {
        "customer_id": customers, "product_id": products, "employee_id": employees})
    return with_profit(sound_amounts(rows))


def clean_returns(raw: DataFrame, orders: DataFrame, sequence: list[str], form: str = "ISO",
                  first=keep_first) -> DataFrame:
    """Runs on cleaned orders, so a dropped order takes its returns along."""
    return (only_known(first(raw, ["return_id"], sequence), "order_id", orders)
            .withColumn("return_date", strict_date("return_date", form)))


def clean_targets(raw: DataFrame, employees: DataFrame, sequence: list[str]) -> DataFrame:
    return only_known(keep_first(raw, ["employee_id", "month", "year"], sequence),
                      "employee_id", employees)


def clean_calendar(raw: DataFrame, form: str = "ISO") -> DataFrame:
    return raw.withColumn("date", strict_date("date", form))


def clean_all(raw: dict[str, DataFrame], sequence: list[str] | None = None
              ) -> dict[str, DataFrame]:
    """All seven tables, lazily, without the sequence columns."""
    seq = list(sequence or SEQUENCE)
    customers = clean_customers(raw["customers"], seq)
    products = clean_products(raw["products"], seq)
    employees = clean_employees(raw["employees"], seq)
    orders = clean_orders(raw["orders"], customers, products, employees, seq)
    cleaned = {
        "date_dimension": clean_calendar(raw["date_dimension"]),
        "customers": customers, "products": products, "employees": employees, "orders": orders,
        "returns": clean_returns(raw["returns"], orders, seq),
        "targets": clean_targets(raw["targets"], employees, seq)}
    return {t: cleaned[t].drop(*seq) for t in SOURCE_TABLES}


def removal_report(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame]) -> DataFrame:
    """Rows before, after and removed, per table."""
    report = None
    for table in raw:
        rows = (raw[table].select(F.lit(1).alias("was"), F.lit(0).alias("is"))
                .unionAll(cleaned[table].select(F.lit(0).alias("was"), F.lit(1).alias("is"))))
        line = rows.agg(
            F.lit(table).alias("table_name"),
            F.coalesce(F.sum("was"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("is"), F.lit(0)).alias("rows_after"))
        report = line if report is None else report.unionByName(line)
    return report.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
