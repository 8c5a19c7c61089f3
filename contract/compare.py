"""Run registered queries against their oracles: python -m contract.compare [folder] [key prefix ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from contract.cases import load
from contract.registry import ORACLES, QUERIES
from tillgrain.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns sorted by name, in a canonical order."""
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in at) for row in rows), key=repr)


def differences(con, query, oracle: str, spark, folder: str) -> tuple[int, str]:
    got = query(spark, folder)
    spark_rows = rows_of(got.columns, [tuple(r) for r in got.collect()])
    want = con.sql(oracle)
    duck_rows = rows_of(want.columns, want.fetchall())
    if sorted(got.columns) != sorted(want.columns):
        return len(spark_rows), f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN"}
    kinds = dict(zip(want.columns, [str(t) for t in want.types]))
    off = [f"{c}: {k} / {kinds[c]}" for c, k in got.dtypes if names.get(k) != kinds[c]]
    if off:
        return len(spark_rows), f"types {off}"
    if len(spark_rows) != len(duck_rows):
        return len(spark_rows), f"{len(spark_rows)} rows / {len(duck_rows)}"
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    return len(spark_rows), f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    load()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                    "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for key, query in QUERIES.items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            if key in ORACLES:
                count, message = differences(con, query, ORACLES[key], spark, folder)
            else:
                count, message = query(spark, folder).count(), ""
        except Exception as error:  # noqa: BLE001 - reported per query
            count, message = -1, f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(message)
        kind = "oracle" if key in ORACLES else "rows  "
        print(f"{'FAIL' if message else 'ok  '} {kind} {key:40s} {count:8d} rows "
              f"{time.time() - began:6.1f}s {message}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
