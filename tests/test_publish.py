"""Versions, and what keeps a load from being published."""

import os

import pytest
from pyspark.sql import functions as F

from contract.feed import append_records, write_csv
from tests.conftest import by, make_star, order, rows
from tillgrain.functions.dates import order_calendar
from tillgrain.model import SCHEMAS
from tillgrain.operators.clean import DATE_FORMS, MixedDates, date_form, form_counts
from tillgrain.operators.quality import ConstraintViolation
from tillgrain.plans import etl, views
from tillgrain.sources import flatfiles, snapshots, warehouse
from tillgrain.sources.star import Star


@pytest.fixture(scope="module")
def star(spark):
    orders = [order(f"O{i}", f"2024-{1 + i % 3:02d}-{1 + i % 27:02d}", f"C{1 + i % 3}",
                    revenue=f"{100 + i}.00") for i in range(300)]
    tables = make_star(spark, orders, targets=[("E1", 1, 2024, "100.00")],
                       returns=[("R1", "O1", "2024-02-05")]).tables()
    tables["date_dimension"] = order_calendar(tables["orders"])
    return Star(**tables)


def changed(star, path, table, change):
    tables = star.tables()
    tables[table] = change(tables[table])
    write_csv(Star(**tables), path)


def load(spark, tmp_path, **more):
    return etl.run_load(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/reports",
                        "2024-06-01", **more)


@pytest.mark.parametrize("table,change,message", [
    ("orders", lambda df: df.withColumn("order_status", F.when(
        F.col("order_id") == "O7", "Pending").otherwise(F.col("order_status"))),
     r"order_status is Completed, Returned or Cancelled \(1 rows\)"),
    ("targets", lambda df: df.withColumn("month", F.lit(13)), r"month between 1 and 12 \(1 rows\)"),
    ("date_dimension", lambda df: df.where("date <> date'2024-02-02'"),
     r"orders.order_date exists in date_dimension"),
    ("returns", lambda df: df.withColumn("return_reason", F.lit(None).cast("string")),
     r"returns.return_reason is filled \(1 rows\)"),
    ("customers", lambda df: df.withColumn("customer_status", F.lit("Asleep")),
     r"customer_status is Active or Inactive \(3 rows\)"),
])
def test_a_row_that_breaks_a_constraint_stops_the_load(spark, star, tmp_path, table, change, message):
    changed(star, f"{tmp_path}/in", table, change)
    with pytest.raises(ConstraintViolation, match=message):
        load(spark, tmp_path)
    assert not os.path.exists(f"{tmp_path}/out")
    report = spark.read.option("header", True).csv(f"{tmp_path}/reports/constraint_report")
    assert report.where("`Failed Records` > 0").count() >= 1


def test_a_failure_between_tables_leaves_the_old_star(spark, star, tmp_path, monkeypatch):
    write_csv(star, f"{tmp_path}/in")
    load(spark, tmp_path)
    changed(star, f"{tmp_path}/next", "orders", lambda df: df.where("order_id <> 'O7'"))
    writer = warehouse.write_table

    def failing(df, path, table):
        if table == "returns":
            raise OSError("disk is gone")
        writer(df, path, table)

    monkeypatch.setattr(etl, "write_table", failing)
    with pytest.raises(OSError, match="disk is gone"):
        etl.run_load(spark, f"{tmp_path}/next", f"{tmp_path}/out", None, "2024-06-01")
    old = warehouse.open_star(spark, f"{tmp_path}/out")
    assert old.orders.count() == 300 and old.returns.count() == 1 and old.scores.count() == 3
    monkeypatch.setattr(etl, "write_table", writer)
    fresh = etl.run_load(spark, f"{tmp_path}/next", f"{tmp_path}/out", None, "2024-06-01")
    assert fresh.orders.count() == 299
    assert old.orders.count() == 300  # an opened star keeps its version


def test_a_replaced_table_carries_the_others(spark, star, tmp_path):
    folder = f"{tmp_path}/out"
    warehouse.store_all({t: star.tables()[t] for t in flatfiles.SOURCE_TABLES}, folder)
    scores = spark.createDataFrame([("C1", 1)], "customer_id string, churn_prediction int")
    for n in range(1, 6):
        warehouse.store_table(scores.limit(n), folder, warehouse.PREDICTIONS)
    opened = warehouse.open_star(spark, folder)
    assert opened.churn.count() == 1 and opened.orders.count() == 300 and opened.scores is None
    assert len(os.listdir(f"{folder}/_published")) == snapshots.KEPT + len(
        [f for f in os.listdir(f"{folder}/_published") if f.startswith(".")])
    with pytest.raises(warehouse.TableNotLoaded, match="rfm_scores"):
        warehouse.load_table(spark, folder, warehouse.SCORES)


def test_two_loads_at_once_do_not_mix(spark, star, tmp_path):
    folder = f"{tmp_path}/out"
    first, second = snapshots.Draft(spark, folder), snapshots.Draft(spark, folder)
    for draft in (first, second):
        warehouse.write_table(star.customers, draft.path("customers"), "customers")
    first.publish()
    with pytest.raises(snapshots.PublishConflict):
        second.publish()
    assert first.version in snapshots.current(spark, folder)["customers"]


def test_dates_of_one_form_load_and_mixed_ones_stop(spark, star, tmp_path):
    slashed = lambda df: df.withColumn("order_date", F.date_format("order_date", "MM/dd/yyyy"))
    changed(star, f"{tmp_path}/in", "orders", slashed)
    assert load(spark, tmp_path).orders.drop("order_month").subtract(star.orders).count() == 0
    changed(star, f"{tmp_path}/mixed/in", "orders", lambda df: df.withColumn("order_date", F.when(
        F.col("order_id") == "O7", F.date_format("order_date", "dd.MM.yyyy")).otherwise(
        F.date_format("order_date", "MM/dd/yyyy"))))
    with pytest.raises(MixedDates, match="M/d/yyyy fits 299 of 300"):
        load(spark, f"{tmp_path}/mixed")


@pytest.mark.parametrize("texts,form", [
    (["2024-01-02", None], "ISO"), (["2024-01-02 10:00:00"], "ISO"), (["01/02/2024", "1/3/2024"], "M/d/yyyy"),
    (["01/02/2024", "13/02/2024"], "d/M/yyyy"), (["20240102"], "yyyyMMdd"), (["2 Jan 2024"], "d MMM yyyy"),
    ([None], "ISO"), ([], "ISO")])
def test_the_first_form_that_fits_all(spark, texts, form):
    assert date_form(spark.createDataFrame([(t,) for t in texts], "day string"), "day") == form


def planted_lines(star, tmp_path):
    write_csv(star, f"{tmp_path}/in")
    with open(f"{tmp_path}/in/orders.csv/part-x.csv", "w") as out:
        out.write(",".join(flatfiles.as_delivered("orders").names) + "\n")
        out.write("O900,2024-01-05,C1\nO901,2024-01-05,C1,P1,E1,1,10.00,0,1.00,1.00,0.00,UPI,Completed,x\n")


def test_records_with_a_wrong_number_of_fields(spark, star, tmp_path):
    planted_lines(star, tmp_path)
    with pytest.raises(flatfiles.BrokenRecords, match="2 records of orders"):
        load(spark, tmp_path)
    assert not os.path.exists(f"{tmp_path}/out")
    loaded = load(spark, tmp_path, quarantine=f"{tmp_path}/aside")
    assert loaded.orders.count() == 300
    aside = spark.read.parquet(f"{tmp_path}/aside/broken_records").collect()
    assert {r["record"].split(",")[0] for r in aside} == {"O900", "O901"}
    assert {r["table_name"] for r in aside} == {"orders"}


def test_a_load_reports_the_rows_it_removed(spark, star, tmp_path):
    changed(star, f"{tmp_path}/in", "orders", lambda df: df.unionByName(df.limit(5)))
    load(spark, tmp_path)
    got = by(spark.read.option("header", True).csv(f"{tmp_path}/reports/rows_removed"), "table_name")
    assert {t: r["rows_removed"] for t, r in got.items() if r["rows_removed"] != "0"} == {"orders": "5"}
    assert got["orders"]["rows_before"] == "305" and got["customers"]["rows_after"] == "3"


def test_the_segment_view_reads_stored_scores(spark, star, tmp_path):
    write_csv(star, f"{tmp_path}/in")
    loaded = load(spark, tmp_path)
    plan = spark.table("vw_rfm_segments")._jdf.queryExecution().optimizedPlan().toString()
    assert "order_status" not in plan
    want = rows(views.rfm_segments(star, "2024-06-01").orderBy("customer_id"))
    assert rows(spark.table("vw_rfm_segments").orderBy("customer_id")) == want
    assert rows(views.rfm_segments(loaded, "2024-06-01").orderBy("customer_id")) == want


def test_a_text_counts_for_all_its_rows(spark):
    texts = spark.createDataFrame([("2024-01-02", 3), ("02.01.2024", 2), (None, 4)], "day string, n bigint")
    counts = texts.agg(*form_counts(F.col("day"), F.col("n"))).first()
    best = [i for i, form in enumerate(DATE_FORMS) if counts[f"fit{i}"]]
    assert counts["texts"] == 5 and counts["fit0"] == 3 and counts["odd0"] == "02.01.2024"
    assert {DATE_FORMS[i]: counts[f"fit{i}"] for i in best} == {"ISO": 3, "d.M.yyyy": 2}


def test_records_are_appended_by_every_task_as_they_are(spark, tmp_path):
    lines = [f' X{i},"O,{i}", a ' for i in range(8)]
    records = spark.createDataFrame([(t,) for t in lines], "value string").repartition(4)
    append_records(records, "returns", str(tmp_path))
    files = list((tmp_path / "returns.csv").glob("part-*"))
    found = [f.read_text().splitlines() for f in files]
    assert len(files) > 1 and {f[0] for f in found} == {",".join(SCHEMAS["returns"].names)}
    assert sorted(line for f in found for line in f[1:]) == lines
