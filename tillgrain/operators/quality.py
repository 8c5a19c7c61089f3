"""Data-quality rules, reported one row per rule.

All row-level rules of a table come out of one aggregate, unfolded into rows at the end. Rules on
keys count per key first, so that a key with many rows is combined before it is shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tillgrain.functions.dates import as_of_column
from tillgrain.model import SCHEMAS, constraints
from tillgrain.operators.keys import repeats, repeats_reread
from tillgrain.operators.ordering import exact_quantiles
from tillgrain.session import pin

# The report's columns, its grades, and the names of the rules below.
REPORT = ("Rule", "Total Records", "Failed Records", "Failure Percentage", "Status")
REPORT_SCHEMA = ("`Rule` string, `Total Records` bigint, `Failed Records` bigint, "
                 "`Failure Percentage` double, `Status` string")
OUTLIER_QUANTILE = 0.995


class QualityGate(RuntimeError):
    """Validation found failing rules; nothing was loaded."""


class ConstraintViolation(RuntimeError):
    """Rows break what the model promises; nothing was published."""


def graded(counts: DataFrame) -> DataFrame:
    """Turn (rule, total, failed) into report rows. The grade looks at the rounded percentage, so a
    share that rounds to zero passes."""
    share = F.when(F.col("total") == 0, F.lit(0).cast("decimal(20,4)")).otherwise(
        F.round(F.col("failed").cast("decimal(20,0)") * 100
                / F.nullif(F.col("total"), F.lit(0)), 4).cast("decimal(20,4)"))
    status = F.when(share == 0, "PASS").when(share < 1, "WARN").otherwise("FAIL")
    return counts.select(
        F.col("rule").alias("Rule"),
        F.col("total").cast("bigint").alias("Total Records"),
        F.col("failed").cast("bigint").alias("Failed Records"),
        share.cast("double").alias("Failure Percentage"),
        status.alias("Status"))


def _counted(df: DataFrame, rules: dict[str, Column], per_row: int | dict[str, int] = 1
             ) -> DataFrame:
    """(rule, total, failed) for every rule, in one pass. A rule's column is what one row adds to
    its failures; ``per_row`` is what one row adds to its total."""
    weight = per_row if isinstance(per_row, dict) else {r: per_row for r in rules}
    sums = df.agg(F.count(F.lit(1)).alias("n"),
                  *[F.coalesce(F.sum(c), F.lit(0)).alias(f"f{i}")
                    for i, c in enumerate(rules.values())])
    lines = F.array(*[F.struct(F.lit(rule).alias("rule"),
                               (F.col("n") * weight.get(rule, 1)).alias("total"),
                               F.col(f"f{i}").cast("bigint").alias("failed"))
                      for i, rule in enumerate(rules)])
    return sums.select(F.inline(lines))


def _yes(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(condition, 1).otherwise(0)


def _missing(columns: list[str]) -> Column:
    total = F.lit(0)
    for column in columns:
        total = total + _yes(F.col(column).isNull())
    return total


def missing_values(table: str, df: DataFrame) -> DataFrame:
    """Empty cells out of all cells."""
    rule = f"Missing values in {table}"
    return _counted(df, {rule: _missing(df.columns)}, len(df.columns))


def repeated_keys(rule: str, df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys are equal to each other."""
    return repeats(df, key).select(F.lit(rule).alias("rule"), "total", "failed")


def unknown_references(rule: str, child: DataFrame, column: str, parent: DataFrame,
                       parent_key: str, null_is_unknown: bool = True) -> DataFrame:
    """Rows that point to no row of the parent, counted per key before the join."""
    return _lost(rule, _references(child, column, parent, parent_key), null_is_unknown)


def _references(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """total, lost and empty: all rows, those whose key is in no row of the parent, and those without a key."""
    keys = child.groupBy(F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("c"))
    known = parent.select(F.col(parent_key).alias("k")).distinct().withColumn("known", F.lit(1))
    k = F.col("k")
    return keys.join(known, "k", "left").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(name) for name, n in (
        ("total", F.col("c")), ("lost", F.when(F.col("known").isNull() & k.isNotNull(), F.col("c"))),
        ("empty", F.when(k.isNull(), F.col("c"))))])


def _lost(rule: str, references: DataFrame, null_is_unknown: bool) -> DataFrame:
    failed = F.col("lost") + F.col("empty") if null_is_unknown else F.col("lost")
    return references.select(F.lit(rule).alias("rule"), "total", failed.alias("failed"))


class KeyCounts:
    """Repeated and unknown keys of stored tables, each counted when a report first asks and kept for the
    others."""

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        self._tables = tables
        self._found: dict[tuple, DataFrame] = {}

    def repeated_keys(self, rule: str, table: str, key: list[str]) -> DataFrame:
        name = (table, *key)
        if name not in self._found:
            self._found[name] = pin(repeats_reread(self._tables[table], key))
        return self._found[name].select(F.lit(rule).alias("rule"), "total", "failed")

    def unknown_references(self, rule: str, table: str, column: str, parent: str, parent_key: str,
                           null_is_unknown: bool = True) -> DataFrame:
        name = (table, column, parent, parent_key)
        if name not in self._found:
            self._found[name] = pin(_references(self._tables[table], column, self._tables[parent], parent_key))
        return _lost(rule, self._found[name], null_is_unknown)


class _Uncounted(KeyCounts):
    """The same, counted lazily with the report."""

    def repeated_keys(self, rule: str, table: str, key: list[str]) -> DataFrame:
        return repeated_keys(rule, self._tables[table], key)

    def unknown_references(self, rule: str, table: str, column: str, parent: str, parent_key: str,
                           null_is_unknown: bool = True) -> DataFrame:
        return unknown_references(rule, self._tables[table], column, self._tables[parent], parent_key,
                                  null_is_unknown)


def order_rules(orders: DataFrame, as_of: dt.date | str | Column | None = None) -> dict[str, Column]:
    """The row-level rules on orders, as what one row adds to each."""
    day = F.col("order_date").cast("string").try_cast("date")
    expected = F.round(F.col("revenue") - F.col("cost"), 2)
    return {
        "Missing values in orders": _missing(orders.columns),
        "Invalid order dates": _yes(day.isNull()),
        "Order dates in the future": _yes(day > as_of_column(as_of)),
        "Negative or zero quantity": _yes(F.col("quantity") <= 0),
        "Negative revenue": _yes(F.col("revenue") < 0),
        "Negative cost": _yes(F.col("cost") < 0),
        "Incorrect profit calculation (profit != revenue - cost)":
            _yes(~F.coalesce(F.round(F.col("profit"), 2) == expected, F.lit(False))),
        "Discount outside [0,1] range": _yes((F.col("discount") < 0) | (F.col("discount") > 1)),
    }


def outlier_rule(orders: DataFrame) -> dict[str, Column]:
    """Orders above the 99.5th percentile of revenue. The percentile itself is found first, exactly
    and without gathering the revenues."""
    edge = exact_quantiles(orders, "revenue", [OUTLIER_QUANTILE])[OUTLIER_QUANTILE]
    above = F.col("revenue").cast("double") > F.lit(edge) if edge is not None else F.lit(False)
    return {"Extreme revenue outliers (>99.5th pct)": _yes(above)}


def judged_orders(orders: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The given rules in one pass over the fact."""
    return _counted(orders, rules, {"Missing values in orders": len(orders.columns)})


def quality_report(tables: dict[str, DataFrame], as_of: dt.date | str | Column | None = None,
                   keys: KeyCounts | None = None) -> DataFrame:
    """All rules over raw or cleaned tables. ``keys`` has counts that reports on the same tables share."""
    orders, keys = tables["orders"], keys or _Uncounted(tables)
    parts = [missing_values(t, tables[t]) for t in ("customers", "products", "employees")]
    parts += [keys.repeated_keys(f"Duplicate {key}", t, [key])
              for t, key in (("customers", "customer_id"), ("products", "product_id"),
                             ("orders", "order_id"))]
    parts.append(judged_orders(orders, order_rules(orders, as_of) | outlier_rule(orders)))
    parts += [keys.unknown_references(f"Invalid {key} references", "orders", key, t, key)
              for t, key in (("customers", "customer_id"), ("products", "product_id"),
                             ("employees", "employee_id"))]
    return graded(stacked(parts))


def stacked(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def constraint_report(tables: dict[str, DataFrame],
                      more: dict[str, dict[str, Column]] | None = None,
                      keys: KeyCounts | None = None) -> DataFrame:
    """The model's own promises as rules: filled columns, unique keys, checks, known parents. ``more``
    adds conditions on a table's rows by their names; they are counted in the same pass. ``keys`` has
    counts that reports on the same tables share."""
    parts, keys = [], keys or _Uncounted(tables)
    for table, declared in constraints().items():
        df = tables[table]
        rules = {f"{table}.{c} is filled": _yes(F.col(c).isNull()) for c in SCHEMAS[table].names}
        rules |= {f"{table}: {name}": _yes(~check) for name, check in declared.checks.items()}
        rules |= {f"{table}: {name}": _yes(~check)
                  for name, check in (more or {}).get(table, {}).items()}
        parts.append(_counted(df, rules))
        parts.append(keys.repeated_keys(f"{table}: ({', '.join(declared.key)}) is unique", table,
                                        list(declared.key)))
        parts += [keys.unknown_references(f"{table}.{column} exists in {parent}", table, column, parent,
                                          parent_key, null_is_unknown=False)
                  for column, (parent, parent_key) in declared.parents.items()]
    return graded(stacked(parts))


def broken_constraints(report: DataFrame) -> dict[str, int]:
    """Constraints that a row breaks, with the number of such rows: one row is enough, whatever
    its share. The report has some hundred rows."""
    return {r["Rule"]: r["Failed Records"]
            for r in report.where(F.col("Failed Records") > 0).orderBy("Rule").collect()}


def quality_summary(report: DataFrame) -> DataFrame:
    status = F.col("Status")
    return report.agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(status == "PASS").alias("passed"),
        F.count_if(status == "WARN").alias("warnings"),
        F.count_if(status == "FAIL").alias("failed"))


def gate(report: DataFrame) -> None:
    """Stop if any rule fails. The report has a few dozen rows."""
    failing = [row["Rule"] for row in report.where(F.col("Status") == "FAIL").collect()]
    if failing:
        raise QualityGate("failing rules: " + "; ".join(sorted(failing)))
