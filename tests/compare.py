"""Compare a Spark result with the oracle's SQL result, order-insensitively and value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return ("timestamp", value.isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    return sorted(names), rows_of(names, result.fetchall())


def differences(spark_side, sql_side) -> str:
    """Empty if both hold the same columns and rows."""
    if spark_side[0] != sql_side[0]:
        return f"columns {spark_side[0]} against {sql_side[0]}"
    only_spark, only_sql = spark_side[1] - sql_side[1], sql_side[1] - spark_side[1]
    if not only_spark and not only_sql:
        return ""
    return (
        f"{spark_side[1].total()} against {sql_side[1].total()} rows, "
        f"only in Spark {list(only_spark.items())[:2]}, only in SQL {list(only_sql.items())[:2]}"
    )
