"""What a load moves and keeps on disk."""

import pytest
from pyspark.sql import functions as F

from contract.feed import write_csv
from tests.conftest import make_star, order, rows
from tillgrain.functions.dates import order_calendar
from tillgrain.operators import clean, keys, quality
from tillgrain.plans import etl
from tillgrain.session import DROPPED, shuffles_dropped
from tillgrain.sources import warehouse
from tillgrain.sources.star import Star

ROWS = "k string, n int, seq int"


def repeating(spark, single=30):
    """Some keys and missing ones come more than once."""
    own = [(f"K{i}", i, i) for i in range(single)]
    return spark.createDataFrame([*own, ("K3", 100, -1), (None, 1, 7), (None, 2, 6), ("K4", 200, 99)], ROWS)


@pytest.mark.parametrize("single", [5, 30])
def test_rows_with_repeated_keys_are_found_by_hashes(spark, single):
    df = repeating(spark, single)
    got, plain = keys.keep_first_reread(df, ["k"], ["seq"]), clean.keep_first(df, ["k"], ["seq"])
    assert got.columns == df.columns
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(plain)))
    assert rows(keys.repeats_reread(df, ["k"])) == rows(keys.repeats(df, ["k"])) == [
        {"total": single + 4, "failed": 3}]


def test_rows_are_not_shuffled_where_no_key_repeats(spark):
    df = spark.createDataFrame([(f"K{i}", i, i) for i in range(20)], ROWS)
    got = keys.keep_first_reread(df, ["k"], ["seq"])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 20
    empty = df.where("n < 0")
    assert keys.keep_first_reread(empty, ["k"], ["seq"]).count() == 0
    assert rows(keys.repeats_reread(empty, ["k"])) == [{"total": 0, "failed": 0}]


def test_keys_that_share_a_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(keys, "_hashed", lambda df, key: df.withColumn(
        keys.HASH, F.when(F.col("n") < 4, F.lit(0)).otherwise(F.col("n"))))
    df = spark.createDataFrame([(f"K{i}", i, i) for i in range(30)] + [("K1", 1, -1)], ROWS)
    got = {r["k"]: r["seq"] for r in rows(keys.keep_first_reread(df, ["k"], ["seq"]))}
    assert got == {f"K{i}": i for i in range(30)} | {"K1": -1}
    assert rows(keys.repeats_reread(df, ["k"])) == [{"total": 31, "failed": 1}]


def loadable(spark):
    tables = make_star(spark, [order(f"O{i}", f"2024-01-{1 + i % 27:02d}", f"C{1 + i % 3}") for i in range(60)],
                       targets=[("E1", 1, 2024, "100.00")], returns=[("R1", "O1", "2024-02-05")]).tables()
    tables["date_dimension"] = order_calendar(tables["orders"])
    return Star(**tables)


def test_every_step_of_a_load_drops_its_shuffles(spark, tmp_path, monkeypatch):
    said = []
    writer, judge = warehouse.write_table, etl.constraint_report
    monkeypatch.setattr(etl, "write_table", lambda df, path, table: (
        said.append(spark.conf.get(DROPPED, "false")), writer(df, path, table)))
    monkeypatch.setattr(etl, "constraint_report", lambda *a: (said.append(spark.conf.get(DROPPED, "false")), judge(*a))[1])
    before = spark.conf.get(DROPPED, None)
    write_csv(loadable(spark), f"{tmp_path}/in")
    etl.run_load(spark, f"{tmp_path}/in", f"{tmp_path}/out", None, "2024-06-01")
    assert said == ["true"] * 9
    assert spark.conf.get(DROPPED, None) == before
    with pytest.raises(OSError), shuffles_dropped(spark):
        raise OSError
    assert spark.conf.get(DROPPED, None) == before


def test_both_reports_of_a_load_count_keys_once(spark, monkeypatch):
    tables, counted = loadable(spark).tables(), []
    tables["orders"] = tables["orders"].unionByName(tables["orders"].where("order_id = 'O5'")).unionByName(
        tables["orders"].where("order_id = 'O6'").withColumn("customer_id", F.lit(None).cast("string"))).unionByName(
        tables["orders"].where("order_id = 'O7'").withColumn("customer_id", F.lit("C9")))
    apart = [rows(quality.quality_report(tables, "2024-06-01")), rows(quality.constraint_report(tables))]
    for name in ("repeats_reread", "_references"):
        own = getattr(quality, name)
        monkeypatch.setattr(quality, name, lambda df, *a, own=own: (counted.append((id(df), a[0] if own.__name__ == "_references" else tuple(a[0]))), own(df, *a))[1])
    shared = quality.KeyCounts(tables)
    assert [rows(quality.quality_report(tables, "2024-06-01", shared)),
            rows(quality.constraint_report(tables, None, shared))] == apart
    assert len(counted) == len(set(counted))


def test_stored_tables_are_compressed_with_the_chosen_codec(spark, tmp_path):
    warehouse.store_all({"returns": loadable(spark).returns}, str(tmp_path))
    files = [str(f) for f in tmp_path.rglob("*.parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
