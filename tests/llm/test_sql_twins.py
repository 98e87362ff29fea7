from __future__ import annotations

import pytest
from oracle import same_rows

from billmill.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, small, name):
    same_rows(spark, QUERIES[name], ORACLE_SQL[name], small)
