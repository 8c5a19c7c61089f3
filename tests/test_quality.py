from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import by, d, frame, make_star, order, rows
from tillgrain.operators import quality

AS_OF = "2024-06-01"


def report_of(star):
    return by(quality.quality_report(star.tables(), AS_OF), "Rule")


def test_faults_are_counted(spark):
    bad = list(order("O3", "2024-02-01", "C1"))
    bad[10] = Decimal("999.00")
    none = list(order("O4", "2024-02-01", "C1"))
    none[10] = None
    star = make_star(spark, [
        order("O1", "2024-02-01", "C1"), order("O1", "2024-02-01", "C9"),
        order("O2", "2024-07-01", None, product="P9", quantity=-1, revenue="-15.00",
              discount="1.2"), tuple(bad), tuple(none), order("O5", None, "C2")])
    got = report_of(star)
    failed = {rule: r["Failed Records"] for rule, r in got.items()}
    assert failed["Duplicate order_id"] == 1
    assert failed["Invalid order dates"] == 1
    assert failed["Order dates in the future"] == 1
    assert failed["Negative or zero quantity"] == 1
    assert failed["Negative revenue"] == 1
    assert failed["Invalid customer_id references"] == 2  # the unknown and the missing one
    assert failed["Invalid product_id references"] == 1
    assert failed["Incorrect profit calculation (profit != revenue - cost)"] == 2
    assert failed["Discount outside [0,1] range"] == 1
    assert failed["Missing values in orders"] == 3
    assert got["Missing values in orders"]["Total Records"] == 6 * 13
    assert set(got["Negative cost"]) == set(quality.REPORT)


def test_grades(spark):
    counts = spark.createDataFrame(
        [("none", 0, 0), ("tiny", 10_000_000, 4), ("some", 1000, 9), ("many", 100, 1)],
        "rule string, total bigint, failed bigint")
    got = by(quality.graded(counts), "Rule")
    assert {r: g["Status"] for r, g in got.items()} == {
        "none": "PASS", "tiny": "PASS", "some": "WARN", "many": "FAIL"}
    assert got["some"]["Failure Percentage"] == 0.9


def test_empty_tables_pass(spark):
    star = make_star(spark, [])
    got = report_of(star)
    assert got["Invalid order dates"]["Status"] == "PASS"
    assert got["Extreme revenue outliers (>99.5th pct)"]["Failed Records"] == 0


def test_gate(spark):
    report = spark.createDataFrame([("a", 1, 0, 0.0, "PASS"), ("b", 1, 1, 100.0, "FAIL")],
                                   quality.REPORT_SCHEMA)
    with pytest.raises(quality.QualityGate, match="failing rules: b"):
        quality.gate(report)
    quality.gate(report.where(F.col("Status") == "PASS"))
    assert rows(quality.quality_summary(report)) == [
        {"total_rules": 2, "passed": 1, "warnings": 0, "failed": 1}]


def test_constraints(spark):
    star = make_star(spark, [order("O1", "2024-02-01", "C1"), order("O1", "2024-02-02", "C9")],
                     returns=[("R1", "O7", "2024-02-03")],
                     targets=[("E1", 13, 2024, "5.00"), ("E1", 13, 2024, "6.00")])
    tables = star.tables()
    tables["date_dimension"] = frame(spark, "date_dimension", [
        (d("2024-02-01"), 1, 2, "February", 1, 2024, 5, "Thursday", 2024)])
    failed = {r["Rule"]: r["Failed Records"] for r in rows(quality.constraint_report(tables))}
    assert failed["orders: (order_id) is unique"] == 1
    assert failed["orders.customer_id exists in customers"] == 1
    assert failed["orders.order_date exists in date_dimension"] == 1
    assert failed["returns.order_id exists in orders"] == 1
    assert failed["targets: (employee_id, month, year) is unique"] == 1
    assert failed["targets: month between 1 and 12"] == 2
