"""Every registered query against its SQL twin on whole tables."""

from __future__ import annotations

import compare
import pytest

from billmill.oracle import oracle_sql
from billmill.queries import registered

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con(small):
    with compare.connect(small) as connection:
        yield connection


def test_every_query_has_a_twin():
    assert set(registered()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(registered()))
def test_same_rows_and_types(spark, small, con, name):
    result, sql = registered()[name](spark, small), oracle_sql()[name]
    assert compare.differences(compare.spark_rows(result), compare.sql_rows(con, sql)) == ""
    declared = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: TYPES.get(t, t.upper()) for c, t in result.dtypes} == declared
