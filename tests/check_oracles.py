"""Compare registered queries with their SQL on one scale: ``python tests/check_oracles.py DIR [name …]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402
from corpusblocks.session import release  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spark_s = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows  {name}: {len(got)} rows, spark {spark_s:.1f}s"
    start = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of(names, cur.fetchall())
    sql_s = time.time() - start
    problem = ""
    if sorted(names) != sorted(df.columns):
        problem = f"columns {sorted(df.columns)} vs {sorted(names)}"
    elif len(got) != len(want):
        problem = f"{len(got)} vs {len(want)} rows"
    elif got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b]
        problem = f"{len(bad)} rows differ, first {bad[0]}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = {n: (t, types.get(n)) for n, t in df.dtypes if kinds.get(t, t) != types.get(n)}
    note = f" types {odd}" if odd else ""
    return f"{'FAIL' if problem else 'ok'}  {name}: {len(got)} rows, spark {spark_s:.1f}s sql {sql_s:.1f}s{note} {problem}"


def main(sf_dir: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    for name in names or list(entry.queries()):
        try:
            print(compare(spark, con, sf_dir, name), flush=True)
        except Exception as e:  # report and go on
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:600]}", flush=True)
        release(spark)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
