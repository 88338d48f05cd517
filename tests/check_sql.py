"""Runs registered queries and their SQL side by side, as a script or from the tests."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, name: str, sf_dir: str) -> tuple[int, float]:
    """Raise unless both sides give the same rows; returns row count and seconds."""
    import __spark_entry__ as entry

    begun = time.time()
    frame = entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = Counter(tuple(row) for row in frame.select(*columns).collect())
    seconds = time.time() - begun
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        result = connection.sql(sql)
        assert sorted(result.columns) == columns, f"{name}: {columns} != {sorted(result.columns)}"
        listed = ", ".join(f'"{c}"' for c in columns)
        want = Counter(connection.sql(f"SELECT {listed} FROM ({sql})").fetchall())
        missing, extra = want - got, got - want
        assert not missing and not extra, (
            f"{name}: {missing.total()} missing, {extra.total()} extra of {want.total()}\n"
            f"missing {list(missing)[:2]!r:.600}\nextra   {list(extra)[:2]!r:.600}"
        )
    return got.total(), seconds


def main(sf_dir: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in names or entry.queries():
        try:
            rows, seconds = compare(spark, connection, name, sf_dir)
            checked = "sql " if name in entry.oracle_sql() else "rows"
            print(f"ok   {checked} {name}: {rows} rows, {seconds:.2f} s", flush=True)
        except Exception as error:  # report every query before giving up
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
