"""The star schema: column types, keys and declared checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F, types as T

PRICE = T.DecimalType(12, 2)
MONEY = T.DecimalType(14, 2)
FRACTION = T.DecimalType(5, 4)
PROBABILITY = T.DecimalType(6, 5)


def _struct(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec.items()])


S, I, D = T.StringType(), T.IntegerType(), T.DateType()

# Fixed values from here on: the columns, keys and checks of the model.
SCHEMAS: dict[str, T.StructType] = {
    "date_dimension": _struct({
        "date": D, "day": I, "month": I, "month_name": S, "quarter": I, "year": I,
        "week": I, "weekday": S, "fiscal_year": I}),
    "customers": _struct({
        "customer_id": S, "customer_name": S, "email": S, "city": S, "state": S, "region": S,
        "customer_segment": S, "acquisition_date": D, "customer_status": S}),
    "products": _struct({
        "product_id": S, "product_name": S, "category": S, "sub_category": S,
        "unit_cost": PRICE, "selling_price": PRICE, "supplier": S, "product_status": S}),
    "employees": _struct({
        "employee_id": S, "employee_name": S, "department": S, "region": S,
        "joining_date": D, "target_amount": MONEY}),
    "orders": _struct({
        "order_id": S, "order_date": D, "customer_id": S, "product_id": S, "employee_id": S,
        "quantity": I, "unit_price": PRICE, "discount": FRACTION, "revenue": MONEY, "cost": MONEY,
        "profit": MONEY, "payment_method": S, "order_status": S}),
    "returns": _struct({
        "return_id": S, "order_id": S, "return_date": D, "return_reason": S,
        "refund_amount": MONEY}),
    "targets": _struct({
        "employee_id": S, "month": I, "year": I, "target_amount": MONEY}),
    "customer_churn_predictions": _struct({
        "customer_id": S, "churn_probability": PROBABILITY, "churn_prediction": I,
        "risk_level": S}),
}

SOURCE_TABLES = ("date_dimension", "customers", "products", "employees", "orders", "returns",
                 "targets")


# Holds, on rows of a stored table that have a value which its column can't store, the values as they
# were delivered. A published table has no such rows.
UNFIT = "_unfit"


def as_delivered(table: str) -> T.StructType:
    """The schema of a source file before cleaning: dates stay text until they are judged."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType)
        for f in SCHEMAS[table].fields])


def _within(column: str, *values: str) -> Column:
    return F.col(column).isin(*values)


@dataclass(frozen=True)
class Constraints:
    """What the model promises about one table, besides every column being filled. A check that
    evaluates to null holds."""

    key: tuple[str, ...]
    checks: dict[str, Column] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)


def constraints() -> dict[str, Constraints]:
    return {
        "date_dimension": Constraints(key=("date",)),
        "customers": Constraints(
            key=("customer_id",),
            checks={"customer_status is Active or Inactive":
                    _within("customer_status", "Active", "Inactive")}),
        "products": Constraints(
            key=("product_id",),
            checks={"unit_cost >= 0": F.col("unit_cost") >= 0,
                    "selling_price >= 0": F.col("selling_price") >= 0,
                    "product_status is Active or Discontinued":
                    _within("product_status", "Active", "Discontinued")}),
        "employees": Constraints(
            key=("employee_id",),
            checks={"target_amount >= 0": F.col("target_amount") >= 0}),
        "orders": Constraints(
            key=("order_id",),
            checks={"quantity > 0": F.col("quantity") > 0,
                    "unit_price >= 0": F.col("unit_price") >= 0,
                    "discount between 0 and 1": F.col("discount").between(0, 1),
                    "revenue >= 0": F.col("revenue") >= 0,
                    "cost >= 0": F.col("cost") >= 0,
                    "order_status is Completed, Returned or Cancelled":
                    _within("order_status", "Completed", "Returned", "Cancelled")},
            parents={"order_date": ("date_dimension", "date"),
                     "customer_id": ("customers", "customer_id"),
                     "product_id": ("products", "product_id"),
                     "employee_id": ("employees", "employee_id")}),
        "returns": Constraints(
            key=("return_id",),
            checks={"refund_amount >= 0": F.col("refund_amount") >= 0},
            parents={"order_id": ("orders", "order_id")}),
        "targets": Constraints(
            key=("employee_id", "month", "year"),
            checks={"month between 1 and 12": F.col("month").between(1, 12),
                    "target_amount >= 0": F.col("target_amount") >= 0},
            parents={"employee_id": ("employees", "employee_id")}),
    }
