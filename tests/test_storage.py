import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import by, make_star, order, rows
from contract.feed import write_csv
from tillgrain.operators.quality import QualityGate
from tillgrain.operators.scope import Filters, scoped_orders
from tillgrain.plans import blocks, etl, jobs
from tillgrain.sources import flatfiles, warehouse
from tillgrain.sources.star import Star


@pytest.fixture
def star(spark):
    from tillgrain.functions.dates import order_calendar
    orders = [order(f"O{i}", f"2024-{1 + i % 3:02d}-{1 + i % 27:02d}", f"C{1 + i % 3}",
                    revenue=f"{100 + i}.00") for i in range(300)]
    made = make_star(spark, orders, targets=[("E1", 1, 2024, "100.00")],
                     returns=[("R1", "O1", "2024-02-05")])
    tables = made.tables()
    tables["date_dimension"] = order_calendar(made.orders)
    return Star(**tables)


def test_load_round_trip(spark, star, tmp_path):
    write_csv(star, f"{tmp_path}/in")
    loaded = etl.run_load(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/reports",
                          "2024-06-01")
    counts = {r["table_name"]: r["row_count"]
              for r in rows(warehouse.loaded_counts(spark, f"{tmp_path}/out"))}
    assert counts["orders"] == 300 and counts["customers"] == 3
    assert loaded.orders.drop("order_month").subtract(star.orders).count() == 0
    assert spark.table("vw_sales_summary").first()["total_orders"] == 300
    page = blocks.data_quality(spark, f"{tmp_path}/reports")
    assert rows(page["summary"])[0]["total_rules"] == 18
    assert rows(page["summary"])[0]["failed"] == 0


def test_raw_files_can_be_judged_alone(spark, star, tmp_path):
    tables = star.tables()
    tables["orders"] = tables["orders"].withColumn("profit", F.lit(1).cast("decimal(14,2)"))
    write_csv(Star(**tables), f"{tmp_path}/in")
    report = by(etl.judge_delivered(spark, f"{tmp_path}/in", f"{tmp_path}/reports"), "Rule")
    assert report["Incorrect profit calculation (profit != revenue - cost)"]["Status"] == "FAIL"


def test_failing_rules_publish_nothing(spark, star, tmp_path):
    tables = star.tables()
    tables["orders"] = tables["orders"].withColumn("payment_method", F.lit(None).cast("string"))
    write_csv(Star(**tables), f"{tmp_path}/in")
    with pytest.raises(QualityGate, match="Missing values in orders"):
        etl.run_load(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert not os.path.exists(f"{tmp_path}/out")


def planted(star, path, values):
    """The star's files, with texts in place of amounts of orders: order id, column, text."""
    tables = star.tables()
    orders = tables["orders"]
    for order_id, column, text in values:
        orders = orders.withColumn(column, F.when(F.col("order_id") == order_id, F.lit(text))
                                   .otherwise(F.col(column).cast("string")))
    tables["orders"] = orders
    write_csv(Star(**tables), path)


def test_amounts_are_judged_as_they_are_delivered(spark, star, tmp_path):
    planted(star, f"{tmp_path}/in", [
        ("O1", "discount", "15"), ("O2", "discount", "-20"), ("O3", "revenue", "-1234567890123456.5"),
        ("O4", "quantity", "-2.5"), ("O5", "quantity", "-3000000000"), ("O6", "quantity", "2.5")])
    report = by(etl.judge_delivered(spark, f"{tmp_path}/in", f"{tmp_path}/reports"), "Rule")
    failed = {rule: r["Failed Records"] for rule, r in report.items()}
    assert failed["Discount outside [0,1] range"] == 2
    assert failed["Negative revenue"] == 1 and failed["Negative or zero quantity"] == 2
    assert failed["Missing values in orders"] == 0


@pytest.mark.parametrize("column,text", [
    ("discount", "15"), ("revenue", "1234567890123456.5"), ("quantity", "2.5")])
def test_a_value_that_cannot_be_stored_stops_the_load(spark, star, tmp_path, column, text):
    planted(star, f"{tmp_path}/in", [("O1", column, text)])
    with pytest.raises(flatfiles.UnfitValue, match=f"1 in {column}"):
        etl.run_load(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/reports", "2024-06-01")
    assert not os.path.exists(f"{tmp_path}/out")


def test_a_load_reads_quoted_line_breaks(spark, star, tmp_path):
    for table, df in star.tables().items():
        if table in flatfiles.SOURCE_TABLES and table != "customers":
            df.write.option("header", True).csv(f"{tmp_path}/in/{table}.csv")
    names = flatfiles.as_delivered("customers").names
    with open(f"{tmp_path}/in/customers.csv", "w") as out:
        out.write(",".join(names) + "\n" + "".join(
            f'C{n},"Ann\nLee",a@x.com,c,s,North,Consumer,2023-01-15,Active\n' for n in (1, 2, 3)))
    loaded = etl.run_load(spark, f"{tmp_path}/in", f"{tmp_path}/out", None, "2024-06-01",
                          multi_line=True)
    assert {r["customer_name"] for r in loaded.customers.collect()} == {"Ann\nLee"}
    report = by(etl.judge_delivered(spark, f"{tmp_path}/in", f"{tmp_path}/reports",
                                    multi_line=True), "Rule")
    assert report["Missing values in customers"]["Failed Records"] == 0


def test_date_filter_reads_only_its_months(spark, star, tmp_path):
    warehouse.store_all(star.tables(), str(tmp_path))
    stored = warehouse.open_star(spark, str(tmp_path))
    narrow = scoped_orders(stored, Filters(date_from="2024-02-03", date_to="2024-02-20"))
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "order_month" in plan[plan.find("PartitionFilters"):].split("PushedFilters")[0]
    want = scoped_orders(star, Filters(date_from="2024-02-03", date_to="2024-02-20"))
    assert narrow.count() == want.count() > 0


def test_missing_file_is_named(spark, tmp_path):
    with pytest.raises(flatfiles.MissingSource, match="date_dimension.csv"):
        flatfiles.read_all_delivered(spark, str(tmp_path))


def test_columns_are_found_by_name(spark, tmp_path):
    with open(f"{tmp_path}/targets.csv", "w") as out:
        out.write("year,target_amount,note,month,employee_id\n"
                  "2024,10.005,x,2.0,E1\nNA,abc,,2.5,None\n")
    got = flatfiles.read_delivered(spark, str(tmp_path), "targets").orderBy("_line")
    first, second = [r.asDict() for r in got.drop("_file", "_block", "_line").collect()]
    assert first == {"employee_id": "E1", "month": 2, "year": 2024,
                     "target_amount": Decimal("10.01")}
    assert set(second.values()) == {None}


def test_missing_column_is_named(spark, tmp_path):
    with open(f"{tmp_path}/targets.csv", "w") as out:
        out.write("year,month,employee_id\n2024,2,E1\n")
    with pytest.raises(flatfiles.MissingColumn, match="target_amount"):
        flatfiles.read_delivered(spark, str(tmp_path), "targets")


def test_missing_report_names_the_job(spark, tmp_path):
    with pytest.raises(warehouse.ReportNotBuilt, match="run the load job first"):
        blocks.data_quality(spark, str(tmp_path))


def test_file_order_survives_many_splits(spark, tmp_path):
    folder = f"{tmp_path}/customers.csv"
    os.makedirs(folder)
    header = "customer_id,customer_name,email,city,state,region,customer_segment," \
             "acquisition_date,customer_status"
    for part in range(2):
        lines = [f"C{i % 50},n{part}-{i},e,c,s,r,g,2024-01-01,Active" for i in range(2000)]
        with open(f"{folder}/part-{part}.csv", "w") as out:
            out.write("\n".join([header, *lines]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        raw = flatfiles.read_delivered(spark, str(tmp_path), "customers")
        from tillgrain.operators.clean import keep_first
        got = by(keep_first(raw, ["customer_id"], list(flatfiles.SEQUENCE)), "customer_id")
        assert raw.rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {k: r["customer_name"] for k, r in got.items()} == {
        f"C{i}": f"n0-{i}" for i in range(50)}


def test_export_quotes_everything(spark, tmp_path):
    df = spark.createDataFrame([("a,b", None, 1.5)], "x string, y string, z double").coalesce(1)
    flatfiles.export_csv(df, f"{tmp_path}/e")
    part = [f for f in os.listdir(f"{tmp_path}/e") if f.endswith(".csv")][0]
    with open(f"{tmp_path}/e/{part}") as lines:
        header, line = lines.read().splitlines()
    assert header == '"x","y","z"'
    assert line in ('"a,b",,"1.5"', '"a,b","","1.5"')


def test_segment_job(spark, tmp_path):
    orders = [order(f"O{i}", f"2024-01-{1 + i:02d}", f"C{i}", revenue=f"{100 + i}.00")
              for i in range(20)]
    star = make_star(spark, orders, customers=[(f"C{i}", "North", "X") for i in range(20)])
    sizes = jobs.run_segments(star, str(tmp_path))
    assert sum(r["count"] for r in rows(sizes)) == 20


def test_forecast_job_feeds_the_page(spark, star, tmp_path):
    jobs.run_forecast(star, str(tmp_path))
    page = blocks.forecast(spark, str(tmp_path))
    assert page["forecast_next_30_days"].count() == 30
    assert page["forecast_next_6_months"].count() == 6
    three = [r["month"] for r in rows(page["forecast_next_3_months"])]
    assert three == ["2024-04", "2024-05", "2024-06"]
    assert page["backtest_error_metrics"].count() == 1


def test_page_bundles(spark, star):
    assert set(blocks.dashboard(star)) == {
        "kpis", "yoy_growth", "revenue_trend", "revenue_by_region", "revenue_by_category",
        "top_products", "customer_segment_distribution"}
    page = blocks.customers(star, page=1, page_size=2, as_of="2024-06-01")
    assert page["customers"].count() == 2
    assert rows(page["pagination"])[0]["total_rows"] == 3
    assert set(blocks.products(star)) >= {"top_10_products", "bottom_10_products"}
    assert set(blocks.sales(star)) and set(blocks.regions(star)) and set(blocks.employees(star))


def test_scratch_can_be_cleared(spark, tmp_path, monkeypatch):
    from tillgrain import session
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    pinned = session.pin(spark.range(10))
    assert pinned.count() == 10 and os.listdir(tmp_path)
    session.clear_scratch(spark)
    assert os.listdir(tmp_path) == []


def test_a_cluster_must_name_its_folder(monkeypatch):
    from types import SimpleNamespace
    from tillgrain import session
    nothing = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(getConf=lambda: nothing, getCheckpointDir=lambda: None,
                              master="spark://somewhere")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(SimpleNamespace(sparkContext=context, conf=nothing))


def test_quoted_quotes_and_line_breaks_are_read(spark, tmp_path):
    names = flatfiles.as_delivered("customers").names
    line = ",".join(['"Ann ""Bo"" Lee\nJr"' if n == "customer_name" else "C1" if n == "customer_id"
                     else "" for n in names])
    (tmp_path / "customers.csv").write_text(",".join(names) + "\n" + line + "\n")
    got = flatfiles.read_delivered(spark, str(tmp_path), "customers", multi_line=True).collect()
    assert [(r["customer_id"], r["customer_name"]) for r in got] == [("C1", 'Ann "Bo" Lee\nJr')]


def test_an_export_reads_back(spark, tmp_path):
    names = flatfiles.as_delivered("customers").names
    row = tuple('say "so", then' if n == "customer_name" else "C1" if n == "customer_id" else None
                for n in names)
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
    flatfiles.export_csv(df, f"{tmp_path}/customers.csv")
    got = flatfiles.read_delivered(spark, str(tmp_path), "customers").first()
    assert got["customer_name"] == 'say "so", then'
