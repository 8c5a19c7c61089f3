"""A raw delivery made from the given tables, with the faults cleaning has to deal with.

Order numbers without part and supplier repeat, so the orders hold many duplicates. Customers and
targets arrive twice, the first time with untidy text. Inactive customers, discontinued products and
the Sales department are not delivered, so orders and targets point to unknown rows. Lowered
quantities and revenues give non-positive ones, profit is wrong, some payment methods are empty, and
raised discounts leave [0, 1]. ``arrival`` orders the rows of each table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillgrain.model import SCHEMAS, SOURCE_TABLES
from tillgrain.session import shuffles_dropped
from tillgrain.sources import linestar
from tillgrain.sources.star import Star

ARRIVAL = ["arrival"]


def delivered(spark: SparkSession, folder: str, bad_dates: bool = False) -> dict[str, DataFrame]:
    lines = linestar.order_lines(spark, folder)
    number = "concat('ORD-', l_orderkey, '-', l_linenumber)"
    day = "cast(order_date as string)"
    if bad_dates:
        day = f"case when order_status = 'Cancelled' then 'unknown' else {day} end"
    orders = lines.selectExpr(
        "order_id as arrival", f"{number} as order_id", f"{day} as order_date", "customer_id",
        "product_id", "employee_id", "quantity - 3 as quantity", "unit_price",
        "cast(discount * 5 as decimal(5,4)) as discount",
        "cast(revenue - 2000 as decimal(14,2)) as revenue", "cost", "revenue as profit",
        "nullif(payment_method, 'Wallet') as payment_method", "order_status")
    # A return comes once per line with its order's number. Such lines share their order key, by which
    # the lines are already together.
    alike = Window.partitionBy("l_orderkey", "order_id")
    returns = linestar.returned_lines(
        lines.withColumn("alike", F.count(F.lit(1)).over(alike)), f"{number} as short", "alike").selectExpr(
        "order_id as arrival", "concat('RET-', substring(short, 5)) as return_id",
        "short as order_id", "cast(return_date as string) as return_date", "return_reason",
        "refund_amount", "explode(sequence(1L, alike)) as copy").where("arrival is not null").drop("copy")

    tidy = (linestar.customers(spark, folder).where("customer_status = 'Active'")
            .withColumn("acquisition_date", F.col("acquisition_date").cast("string")))
    untidy = (tidy.withColumn("customer_name", F.concat(F.lit("  "), "customer_name", F.lit(" ")))
              .withColumn("email", F.upper("email")))
    customers = (untidy.withColumn("arrival", F.lit(1))
                 .unionByName(tidy.withColumn("arrival", F.lit(2))))
    products = (linestar.products(spark, folder).where("product_status = 'Active'")
                .withColumn("unit_cost", F.expr("cast(selling_price * 0.3335 as decimal(20,6))"))
                .withColumn("arrival", F.lit(1)))
    employees = (linestar.employees(spark, folder).where("department <> 'Sales'")
                 .withColumn("joining_date", F.col("joining_date").cast("string"))
                 .withColumn("arrival", F.lit(1)))
    once = linestar.targets(spark, folder)
    again = once.withColumn("target_amount",
                            (F.col("target_amount") + 1).cast("decimal(14,2)"))
    targets = (once.withColumn("arrival", F.lit(1))
               .unionByName(again.withColumn("arrival", F.lit(2))))
    calendar = (linestar.calendar(spark, folder)
                .withColumn("date", F.col("date").cast("string")).withColumn("arrival", F.lit(1)))
    return {"date_dimension": calendar, "customers": customers, "products": products,
            "employees": employees, "orders": orders, "returns": returns, "targets": targets}


def write_csv(star: Star, folder: str) -> None:
    """The star as seven delivered files, compressed: a file is what one task has written."""
    tables = star.tables()
    with shuffles_dropped(tables["orders"].sparkSession):
        for table in SOURCE_TABLES:
            (tables[table].write.option("header", True).option("escape", '"').option("compression", "gzip")
             .csv(f"{folder}/{table}.csv"))


def append_records(records: DataFrame, table: str, folder: str) -> None:
    """Texts as further records of a delivered table, as they are. Each task writes files with a header
    of their own; the text stands in one column that is named like the header."""
    with shuffles_dropped(records.sparkSession):
        (records.toDF(",".join(SCHEMAS[table].names)).write.mode("append")
         .options(header=True, sep="\u0001", quote="\u0002", emptyValue="",
                  ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
         .csv(f"{folder}/{table}.csv"))
