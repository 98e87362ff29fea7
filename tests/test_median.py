from __future__ import annotations

import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billmill.operators.median import _PER_OCTAVE, exact_median, flag_above


def median_of(spark, values, parts=4):
    rows = [(None if v is None else float(v),) for v in values]
    return exact_median(spark.createDataFrame(rows, "x DOUBLE").repartition(parts), "x").first()[0]


CASES = [
    [],
    [None, None],
    [5],
    [1, 2],
    [1, 2, 3, 4, None],
    [0, 0, 7],
    [-0.0, 0.0, 1.0],
    [-1, -2, 3, 4],
    [-3, -2, -1],
    [math.inf, 1],
    [-math.inf, 2, 3, math.inf],
    [math.nan, 1, 2, 3],
    [5e-324, 1e308, -1e308],
    [1e308, 1.7e308],
    [1] * 10 + [1e6] * 10,
    [7] * 1000 + [1, 2, 3],
    [1 + i * 2.0**-52 for i in range(501)],
    [0.1 * i for i in range(1000)],
    [random.Random(1).uniform(-1, 1) * 10.0 ** random.Random(i).randint(-300, 300) for i in range(2000)],
]


def expected(values):
    known = [float(v) for v in values if v is not None and not math.isnan(v)]
    if not known:
        return None
    known.sort()
    low, high = known[(len(known) - 1) // 2], known[len(known) // 2]
    return low if low == high else (low + high) / 2


@pytest.mark.parametrize("case", range(len(CASES)))
def test_cases(spark, case):
    assert median_of(spark, CASES[case]) == expected(CASES[case])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_any_values(spark, values):
    assert median_of(spark, values, 2) == expected(values)


def test_same_as_the_builtin_on_a_whole_table(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    for column in ("l_extendedprice", "l_quantity"):
        builtin = lines.agg(F.median(column)).first()[0]
        assert exact_median(lines, column).first()[0] == builtin
    prices = [row[0] for row in lines.select("l_extendedprice").collect()]
    assert exact_median(lines, "l_extendedprice").first()[0] == statistics.median(prices)


def test_cells_rise_with_the_values(spark):
    from billmill.operators.median import _log_cell

    values = sorted([s * 1.5**e for s in (-1, 1) for e in range(-1700, 1700, 7)] + [0.0, math.inf, -math.inf])
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE").coalesce(1)
    cells = [row[0] for row in rows.select(_log_cell(F.col("v"))).collect()]
    assert cells == sorted(cells)
    assert max(cells) < 2**12 * _PER_OCTAVE


def test_flag(spark):
    bills = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "kwh DOUBLE").coalesce(1)
    flagged = flag_above(bills, "kwh", exact_median(bills, "kwh"), "high")
    assert [row.high for row in flagged.collect()] == [0, 0, 1, 0]
    nothing = bills.where("kwh > 9")
    assert flag_above(bills, "kwh", exact_median(nothing, "kwh"), "high").agg(F.sum("high")).first()[0] == 0
