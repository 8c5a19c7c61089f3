"""Order-line tables (lineitem, orders, customer, part, supplier, nation, region) seen as the star.

The mapping is the one FIXTURES.md lists. Everything is a lazy projection, so a report that reads
three columns of the fact scans only the columns those need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillgrain.functions.dates import order_calendar
from tillgrain.sources.star import Star

# Column types of the tables read here; naming them spares Spark the look into the files.
_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(_TABLES[table]).parquet(f"{folder}/{table}.parquet")


_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
_DISCOUNT = "cast(cast(l_discount as decimal(5,2)) * 2.5 as decimal(5,4))"

_MAY_BE_RETURNED = "l_returnflag = 'R' and l_linenumber <= 2"

_ORDER_LINES = {
    "order_id": "concat('ORD-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, "
                f"'-', {_CENTS})",
    "order_date": "cast(o_orderdate as date)",
    "customer_id": "o_custkey",
    "product_id": "l_partkey",
    "employee_id": "l_suppkey",
    "quantity": "cast(l_quantity as int)",
    "unit_price": f"cast(cast(({_CENTS} - {_CENTS} % cast(l_quantity as bigint)) / "
                  "cast(l_quantity as bigint) as bigint) * cast(0.01 as decimal(3,2)) "
                  "as decimal(12,2))",
    "discount": _DISCOUNT,
    "revenue": f"cast(round(cast(l_extendedprice as decimal(14,2)) * (1 - {_DISCOUNT}), 2) "
               "as decimal(14,2))",
    "cost": "cast(round(cast(l_extendedprice as decimal(14,2)) * "
            "cast(0.45 + 0.01 * (l_partkey % 41) as decimal(4,2)), 2) as decimal(14,2))",
    "payment_method": "case l_linenumber % 3 when 0 then 'Card' when 1 then 'UPI' "
                      "else 'Wallet' end",
    "order_status": "case when o_orderstatus = 'P' and l_linenumber = 1 then 'Cancelled' "
                    f"when {_MAY_BE_RETURNED} then 'Returned' "
                    "else 'Completed' end",
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
}

_FACT = ["order_id", "order_date", "customer_id", "product_id", "employee_id", "quantity",
         "unit_price", "discount", "revenue", "cost", "profit", "payment_method", "order_status"]


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} as {name}" for name, expr in columns.items()])


def order_lines(spark: SparkSession, folder: str, kept: str = "true") -> DataFrame:
    """The lines of the table that are ``kept``, with their heads."""
    lines = read_table(spark, folder, "lineitem").where(kept)
    heads = read_table(spark, folder, "orders")
    joined = lines.join(heads, lines.l_orderkey == heads.o_orderkey)
    return (_project(joined, _ORDER_LINES)
            .withColumn("profit", (F.col("revenue") - F.col("cost")).cast("decimal(14,2)")))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder).select(*_FACT)


def returns(spark: SparkSession, folder: str) -> DataFrame:
    # All that may have the status; whether a line has it depends on its head as well.
    return returned_lines(order_lines(spark, folder, _MAY_BE_RETURNED))


def returned_lines(lines: DataFrame, *more: str) -> DataFrame:
    """The returns among the order lines, with ``more`` of their line."""
    returned = lines.where(F.col("order_status") == "Returned")
    return returned.selectExpr(*[f"{expr} as {name}" for name, expr in {
        "return_id": "concat('RET-', substring(order_id, 5))",
        "order_id": "order_id",
        "return_date": "order_date + cast(1 + (l_orderkey + l_linenumber) % 20 as int)",
        "return_reason": "case l_orderkey % 3 when 0 then 'Defective Product' "
                         "when 1 then 'Changed Mind' else 'Late Delivery' end",
        "refund_amount": "revenue"}.items()], *more)


def _placed(spark: SparkSession, folder: str, table: str, nation_key: str) -> DataFrame:
    nations = read_table(spark, folder, "nation").join(
        read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return read_table(spark, folder, table).join(nations,
                                                 F.col(nation_key) == F.col("n_nationkey"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return _project(_placed(spark, folder, "customer", "c_nationkey"), {
        "customer_id": "c_custkey",
        "customer_name": "c_name",
        "email": "lower(concat(replace(c_name, '#', '.'), '@example.com'))",
        "city": "n_name",
        "state": "n_name",
        "region": "r_name",
        "customer_segment": "c_mktsegment",
        "acquisition_date": "date '1995-01-01' + cast(c_custkey * 37 % 2400 as int)",
        "customer_status": "case when c_acctbal < 0 then 'Inactive' else 'Active' end"})


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _project(read_table(spark, folder, "part"), {
        "product_id": "p_partkey",
        "product_name": "concat(p_name, ' ', p_partkey)",
        "category": "p_type",
        "sub_category": "p_brand",
        "unit_cost": "cast(round(cast(p_retailprice as decimal(12,2)) * "
                     "cast(0.45 + 0.01 * (p_partkey % 41) as decimal(4,2)), 2) as decimal(12,2))",
        "selling_price": "cast(p_retailprice as decimal(12,2))",
        "supplier": "concat('SUP-', p_partkey % 20)",
        "product_status": "case when p_partkey % 12 = 0 then 'Discontinued' else 'Active' end"})


def employees(spark: SparkSession, folder: str) -> DataFrame:
    return _project(_placed(spark, folder, "supplier", "s_nationkey"), {
        "employee_id": "s_suppkey",
        "employee_name": "s_name",
        "department": "case s_suppkey % 4 when 0 then 'Sales' when 1 then 'Key Accounts' "
                      "when 2 then 'Field Sales' else 'Inside Sales' end",
        "region": "r_name",
        "joining_date": "date '1995-01-01' + cast(s_suppkey * 53 % 2000 as int)",
        "target_amount": "cast(3200000 + (s_suppkey * 7919 % 1000) * 2100 as decimal(14,2))"})


def targets(spark: SparkSession, folder: str) -> DataFrame:
    """One target per employee and month with orders. The months of the whole history fit in one
    array, which every employee row then unfolds."""
    heads = read_table(spark, folder, "orders")
    months = (heads.select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("m"))
              .distinct().agg(F.array_sort(F.collect_list("m")).alias("months"))
              .withColumn("_one", F.lit(1)))
    staff = (read_table(spark, folder, "supplier")
             .select(F.col("s_suppkey").alias("employee_id"),
                     F.expr("cast(3200000 + (s_suppkey * 7919 % 1000) * 2100 as decimal(14,2))")
                     .alias("target_amount"), F.lit(1).alias("_one")))
    # One row with one entry per calendar month: small at any scale.
    spread = (staff.join(F.broadcast(months), "_one")
              .select("employee_id", "target_amount", F.explode("months").alias("m"))
              .select("employee_id", "target_amount", F.month("m").alias("month"),
                      F.year("m").alias("year")))
    return spread.selectExpr(
        "employee_id", "month", "year",
        "cast(round(target_amount * (85 + (employee_id * 31 + year * 12 + month) % 31) / 1200, 2) "
        "as decimal(14,2)) as target_amount")


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """A stand-in for model output with exact values."""
    return _project(read_table(spark, folder, "customer"), {
        "customer_id": "c_custkey",
        "churn_probability": "cast(cast((c_custkey * 7919) % 100000 as decimal(10,0)) / 100000 "
                             "as decimal(6,5))",
        "churn_prediction": "case when (c_custkey * 7919) % 100000 >= 50000 then 1 else 0 end",
        "risk_level": "case when (c_custkey * 7919) % 100000 <= 33000 then 'Low' "
                      "when (c_custkey * 7919) % 100000 <= 66000 then 'Medium' else 'High' end"})


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    heads = read_table(spark, folder, "orders")
    return order_calendar(heads.select(F.col("o_orderdate").cast("date").alias("order_date")))


def star_from_lines(spark: SparkSession, folder: str) -> Star:
    def opened(table):
        return lambda: table(spark, folder)

    return Star(orders=opened(orders), customers=opened(customers), products=opened(products),
                employees=opened(employees), returns=opened(returns), targets=opened(targets),
                date_dimension=opened(calendar), churn=opened(predictions))
