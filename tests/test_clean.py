from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import by, rows
from tillgrain.model import SOURCE_TABLES, as_delivered
from tillgrain.operators import clean

SEQ = ["seq"]


def delivered(spark, table, lines):
    schema = as_delivered(table).add("seq", "integer")
    return spark.createDataFrame([(*line, i) for i, line in enumerate(lines)], schema)


CUSTOMER = ("C1", " Alice ", " A@X.com ", "Pune", "MH", "West", "Consumer", "2024-01-01", "Active")
PRODUCT = ("P1", "Widget", "Electronics", "Accessories", Decimal("10.00"), Decimal("15.00"),
           "Acme", "Active")
EMPLOYEE = ("E1", "Bob", "Sales", "West", "2023-01-01", Decimal("100000.00"))


def order(oid, day="2024-02-01", c="C1", p="P1", e="E1", q=2, rev="30.00", cost="20.00",
          profit="999.00", status="Completed"):
    return (oid, day, c, p, e, q, Decimal("15.00"), Decimal("0"),
            Decimal(rev) if rev is not None else None, Decimal(cost), Decimal(profit), "UPI",
            status)


@pytest.fixture
def raw(spark):
    return {
        "customers": delivered(spark, "customers", [
            CUSTOMER, ("C1", "Alice", "a@x.com", *CUSTOMER[3:]), (None, *CUSTOMER[1:]),
            (None, "Second", *CUSTOMER[2:])]),
        "products": delivered(spark, "products", [PRODUCT]),
        "employees": delivered(spark, "employees", [EMPLOYEE]),
        "orders": delivered(spark, "orders", [
            order("O1"), order("O2", q=-1, rev="-15.00"), order("O1", rev="77.00"),
            order("O3", c="C9"), order("O4", p="P9"), order("O5", e="E9"), order("O6", rev=None),
            order("O7", c=None), order("O8", rev="0.00", cost="0.00")]),
        "returns": delivered(spark, "returns", [
            ("R1", "O1", "2024-02-10", "Late", Decimal("30.00")),
            ("R1", "O8", "2024-02-11", "Late", Decimal("30.00")),
            ("R2", "O2", "2024-02-10", "Late", Decimal("30.00"))]),
        "targets": delivered(spark, "targets", [
            ("E1", 2, 2024, Decimal("8000.00")), ("E1", 2, 2024, Decimal("1.00")),
            ("E9", 2, 2024, Decimal("1.00"))]),
        "date_dimension": delivered(spark, "date_dimension", [
            ("2024-02-01", 1, 2, "February", 1, 2024, 5, "Thursday", 2024)])}


def test_first_customer_is_kept_and_tidied(raw):
    got = rows(clean.clean_all(raw, SEQ)["customers"])
    assert len(got) == 2  # C1, and one row for the missing ids
    first = [r for r in got if r["customer_id"] == "C1"][0]
    assert (first["customer_name"], first["email"]) == ("Alice", "a@x.com")
    assert str(first["acquisition_date"]) == "2024-01-01"


def test_orders_lose_bad_rows_and_keep_the_first(raw):
    got = by(clean.clean_all(raw, SEQ)["orders"], "order_id")
    assert set(got) == {"O1", "O8"}
    assert got["O1"]["revenue"] == Decimal("30.00")
    assert got["O1"]["profit"] == Decimal("10.00")


def test_dropped_orders_take_their_returns_along(raw):
    got = rows(clean.clean_all(raw, SEQ)["returns"])
    assert [(r["return_id"], r["order_id"]) for r in got] == [("R1", "O1")]


def test_targets(raw):
    got = rows(clean.clean_all(raw, SEQ)["targets"])
    assert [(r["employee_id"], r["target_amount"]) for r in got] == [("E1", Decimal("8000.00"))]


def test_bad_date_stops_the_job(spark, raw):
    raw["orders"] = raw["orders"].withColumn("order_date", F.lit("2024-13-01"))
    with pytest.raises(Exception, match="order_date is not a date: 2024-13-01"):
        clean.clean_all(raw, SEQ)["orders"].collect()


def test_missing_date_is_not_a_bad_date(spark):
    df = spark.createDataFrame([(None,), ("2024-02-29",)], "x string")
    got = [r[0] for r in df.select(clean.strict_date("x")).collect()]
    assert [str(g) for g in got] == ["None", "2024-02-29"]


def test_removal_report(raw):
    report = by(clean.removal_report(raw, clean.clean_all(raw, SEQ)), "table_name")
    assert set(report) == set(SOURCE_TABLES)
    assert report["orders"]["rows_before"] == 9
    assert report["orders"]["rows_removed"] == 7


def test_copies_of_a_key_are_thinned_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3 % 1).alias("k"), F.col("id").alias("seq"))
    got = clean.keep_first(df, ["k"], ["seq"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    first, last = plan.find("WindowGroupLimit"), plan.rfind("WindowGroupLimit")
    assert 0 <= first < plan.find("Exchange") < last
    assert rows(got) == [{"k": 0, "seq": 0}]


def test_rows_are_known_by_the_keys_that_no_parent_has(spark):
    keys = "k string, p string, n int"
    df = spark.createDataFrame([("A", "X", 1), ("B", "X", 2), (None, "X", 3), ("A", "Y", 4), ("A", "X", 5)], keys)
    more = df.unionByName(spark.createDataFrame([("Z", "X", 6)], keys))
    parents = {"k": spark.createDataFrame([("A",), ("A",), (None,)], "k string"),
               "p": spark.createDataFrame([("X",)], "p string")}
    got = clean.only_all_known(df, more, parents)
    assert got.columns == df.columns and sorted(r["n"] for r in rows(got)) == [1, 5]
