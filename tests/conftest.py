import datetime as dt
from decimal import Decimal

import pytest

from tillgrain.model import SCHEMAS
from tillgrain.session import build_session
from tillgrain.sources.star import Star


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
        "spark.default.parallelism": "8",
        # Small tables and many short plans: compile less.
        "spark.sql.codegen.wholeStage": "false",
        "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SCHEMAS[table])


def d(text):
    return dt.date.fromisoformat(text)


def order(order_id, day, customer, product="P1", employee="E1", revenue="100.00", cost="60.00",
          status="Completed", discount="0", quantity=1):
    rev, cst = Decimal(revenue), Decimal(cost)
    return (order_id, d(day) if day else None, customer, product, employee, quantity,
            Decimal("10.00"), Decimal(discount), rev, cst, rev - cst, "UPI", status)


def make_star(spark, orders, customers=None, returns=(), targets=(), products=None,
              employees=None, churn=None):
    """A small star. Customers are (id, region, segment)."""
    customers = customers or [("C1", "North", "Consumer"), ("C2", "South", "Corporate"),
                              ("C3", "North", "Consumer")]
    products = products or [("P1", "Widget", "Tools"), ("P2", "Gadget", "Toys")]
    employees = employees or [("E1", "Bob", "1000.00"), ("E2", "Eve", "500.00")]
    frames = {
        "orders": list(orders),
        "customers": [(c, f"Name {c}", f"{c}@x.com", "City", "State", region, segment,
                       d("2023-01-15"), "Active") for c, region, segment in customers],
        "products": [(p, name, category, "Sub", Decimal("6.00"), Decimal("10.00"), "Acme",
                      "Active") for p, name, category in products],
        "employees": [(e, name, "Sales", "North", d("2022-01-01"), Decimal(target))
                      for e, name, target in employees],
        "returns": [(r, o, d(day), "Late", Decimal("1.00")) for r, o, day in returns],
        "targets": [(e, m, y, Decimal(a)) for e, m, y, a in targets],
        "date_dimension": []}
    made = {t: frame(spark, t, rows) for t, rows in frames.items()}
    scores = frame(spark, "customer_churn_predictions",
                   [(c, Decimal(p), g, r) for c, p, g, r in churn]) if churn is not None else None
    return Star(churn=scores, **made)


def rows(df):
    return [r.asDict() for r in df.collect()]


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
