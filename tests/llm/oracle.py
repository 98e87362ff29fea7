"""Runs a query and its SQL twin over the same small tables and compares the rows."""

from __future__ import annotations

import os

import duckdb


def sql_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    db = duckdb.connect()
    for name in os.listdir(folder):
        place = os.path.join(folder, name)
        files = place + "/*.parquet" if os.path.isdir(place) else place
        db.execute(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{files}')")
    result = db.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def same_rows(spark, query, sql: str, folder: str) -> None:
    names, wanted = sql_rows(folder, sql)
    found = query(spark, folder)
    assert set(names) <= set(found.columns)
    key = lambda row: tuple((x is None, str(x)) for x in row)
    rows = [tuple(row) for row in found.select(*names).collect()]
    assert sorted(rows, key=key) == sorted(wanted, key=key)
