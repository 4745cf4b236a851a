"""Run the registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/compare.py [sf_dir] [key ...]

Settings of the session can be given as "name=value,..." in COMPARE_CONF.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


def difference(spark_df, connection, sql: str) -> str | None:
    """First difference between both results, None if they are equal."""
    left = rows(spark_df.columns, spark_df.collect())
    result = connection.sql(sql)
    right = rows(result.columns, result.fetchall())
    if sorted(spark_df.columns) != sorted(result.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(result.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if [repr(float(v)) if isinstance(v, (int, float)) else v for v in a] != [
            repr(float(v)) if isinstance(v, (int, float)) else v for v in b
        ]:
            return f"{a} != {b}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for setting in filter(None, os.environ.get("COMPARE_CONF", "").split(",")):
        builder = builder.config(*setting.split("=", 1))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        df = query(spark, sf_dir)
        if name not in oracle:
            print(f"{name:30} {time.time() - start:6.2f}s rows {df.count()}", flush=True)
            continue
        problem = difference(df, connection, oracle[name])
        bad += problem is not None
        result = "ok" if problem is None else f"DIFF {problem}"
        print(f"{name:30} {time.time() - start:6.2f}s {result}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
