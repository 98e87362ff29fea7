from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from billmill.operators import keys
from billmill.operators.checks import foreign_key_report, primary_key_report
from billmill.operators.clean import mark_bills
from billmill.operators.keys import n_ranges, number_rows
from billmill.plans.staging import build_staging, clean_bills, stage_counts
from billmill.sources.sales_bills import SALES_ORDER, read_sales_bills
from billmill.workspace import stored


def test_ranges_follow_the_stored_bytes():
    assert [n_ranges(b) for b in (0, 1, 256 << 20, (256 << 20) + 1)] == [1, 1, 1, 2]
    assert n_ranges(100 << 40) == 409_600  # offsets: one row of two numbers each, 7 MB
    assert n_ranges(100 << 40, 1 << 30) == 102_400


@pytest.mark.parametrize("ranges", [1, 7, 50])
def test_the_same_keys_for_any_number_of_ranges(spark, monkeypatch, ranges):
    monkeypatch.setattr(keys, "n_ranges", lambda *_: ranges)
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("id"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("of"))
    rows = number_rows(df, ["of", "id"], "key").orderBy("key").collect()
    want = sorted(((r["of"], r["id"]) for r in df.collect()), key=lambda r: (r[0] is not None, r))
    assert [(r["key"], r["of"], r["id"]) for r in rows] == [(i, *row) for i, row in enumerate(want, 1)]


def test_a_hot_order_value_is_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(keys, "n_ranges", lambda *_: 8)
    placed = []
    monkeypatch.setattr(keys, "stored_at", lambda df, name, f=keys.stored_at: placed.append(f(df, name)) or placed[-1])
    df = spark.range(0, 4000, 1, 4).select(F.lit("hot").alias("of"), F.lit(1).alias("equal"))
    assert [r.key for r in number_rows(df, ["of"], "key").orderBy("key").collect()] == list(range(1, 4001))
    sizes = [r["count"] for r in placed[-1][0].groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def plain_foreign_keys(facts, dims):
    out = {}
    for key, members in dims.items():
        values = [row[key] for row in facts]
        out[key] = (len(values), values.count(None), sum(v is not None and v not in members for v in values))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_foreign_keys_by_bits(spark, seed):
    rng = random.Random(seed)
    wide = [0, 1, 63, 64, 65, -1, -64, 10**12, 2**62, 127, 128]
    dims = {"a": set(range(1, 200)) - {rng.randrange(200)}, "b": set(rng.sample(wide, 6)), "c": set()}
    facts = [{"a": rng.choice([None, *range(1, 201)]), "b": rng.choice([None, *wide]), "c": rng.choice([None, 5])} for _ in range(500)]
    df = spark.createDataFrame([(f["a"], f["b"], f["c"]) for f in facts], "a int, b long, c int")
    tables = {k: (spark.createDataFrame([(m,) for m in sorted(v)], "member long"), "member") for k, v in dims.items()}
    report = {r.key_column: (r.row_count, r.null_keys, r.orphan_rows) for r in foreign_key_report(df, tables).collect()}
    assert report == plain_foreign_keys(facts, dims)


@pytest.mark.parametrize("values", [[], [1, 2, 3], [1, 1, 1, 2, 64, 64, 65], [None, None, 7], [0, -1, -1, 2**40, 2**40, None], [*range(1, 500), 70]])
def test_primary_keys_by_bits(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k long")
    other = spark.createDataFrame([("x",), ("x",), (None,)], "k string")
    report = {r.table_name: r[1:] for r in primary_key_report({"t": (df, ["k"]), "u": (df, ["k"]), "text": (other, ["k"])}).collect()}
    twice = len({v for v in values if v is not None and values.count(v) > 1})
    want = (len(values), values.count(None), twice)
    assert {k: tuple(v) for k, v in report.items()} == {"t": want, "u": want, "text": (3, 1, 1)}


def test_whole_keys_are_checked_with_two_shuffles(spark):
    df = stored(spark.range(1000).selectExpr("id + 1 AS k"), "dense")
    report = primary_key_report({f"t{i}": (df, ["k"]) for i in range(5)})
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") <= 2


def test_marked_bills_are_not_parsed_again(spark, small):
    raw = stored(mark_bills(read_sales_bills(spark, small)), "raw")
    staged = stored(build_staging(raw, SALES_ORDER), "staged")
    plain = build_staging(stored(read_sales_bills(spark, small), "raw"), SALES_ORDER)
    assert staged.columns == plain.columns
    assert sorted(map(str, staged.collect())) == sorted(map(str, plain.collect()))
    for df in (clean_bills(raw, SALES_ORDER), stage_counts(raw, staged, SALES_ORDER)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "to_timestamp" not in plan and "gettimestamp" not in plan and "try_cast" not in plan
    columns = stage_counts(raw, staged, SALES_ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_stage:tinyint>" in columns
