from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from billmill.operators.dedup import keep_first
from billmill.operators.keys import number_rows


def numbered(df, order, **options):
    return {row["key"]: tuple(row[o] for o in order) for row in number_rows(df, order, "key", **options).collect()}


def nulls_first(values):
    return tuple((v is not None, v) for v in values)


@pytest.mark.parametrize("partitions", ["1", "7", "50"])
def test_numbers_follow_the_order(spark, partitions):
    rows = [(f"n{i % 13}" if i % 5 else None, i * 7919 % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "name STRING, place INT").repartition(11)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        keys = numbered(df, ["name", "place"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [keys[k] for k in sorted(keys)] == sorted(rows, key=nulls_first)
    assert sorted(keys) == list(range(1, 1001))


def test_several_ranges_without_merging(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("v"))
        keys = numbered(df, ["v"])
        assert keys == {i + 1: (i,) for i in range(5000)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_numbering_nothing(spark):
    empty = number_rows(spark.range(0), ["id"], "key", "int")
    assert empty.count() == 0 and empty.dtypes == [("key", "int"), ("id", "bigint")]


def hot_bills(spark, rows=30000):
    """A third of all rows share one key."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"),
        (F.col("id") * 104729 % rows).alias("place"),
    )


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_first_row_whatever_the_partitioning(spark, partitions):
    bills = hot_bills(spark)
    want = {row.key: row.place for row in bills.groupBy("key").agg(F.min("place").alias("place")).collect()}
    kept = keep_first(bills.repartition(partitions), ["key"], ["place"]).collect()
    assert {row.key: row.place for row in kept} == want and len(kept) == len(want)


def test_a_hot_key_shrinks_before_the_shuffle(spark):
    plan = keep_first(hot_bills(spark), ["key"], ["place"])._jdf.queryExecution().executedPlan().toString()
    partial, shuffle = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert plan.index("row_number(), 1, Final") < shuffle < partial
    assert "SinglePartition" not in plan


def test_without_keys_everything_stays(spark):
    assert keep_first(spark.range(5), [], ["id"]).count() == 5


def test_keys_do_not_depend_on_the_partitions(spark):
    rows = spark.range(2000).selectExpr("id % 40 AS hot", "id * 7919 % 2003 AS place", "id")
    found = [sorted(map(tuple, number_rows(rows.repartition(n), ["hot", "place"], "key").collect())) for n in (1, 7, 50)]
    assert found[0] == found[1] == found[2]
    assert [row[0] for row in found[0]] == list(range(1, 2001))
