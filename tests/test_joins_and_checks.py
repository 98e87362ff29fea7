from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billmill.functions.totals import merged_total, partial_totals, total
from billmill.operators import checks
from billmill.operators.joins import join_members, lookup_key
from billmill.plans import star


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_totals(spark):
    data = [
        ("cents", 0.1), ("cents", 0.2), ("cents", None),
        ("none", None),
        ("big", 1e300), ("big", 1.0),
        ("fine", 1e-9), ("fine", 1e-9),
        ("inf", math.inf), ("inf", 5.0),
    ]
    df = spark.createDataFrame(data, "k STRING, x DOUBLE").repartition(5)
    want = {"cents": 0.3, "none": None, "big": 1e300, "fine": 2e-9, "inf": math.inf}
    assert dict(rows(df.groupBy("k").agg(total(F.col("x"))))) == want
    halves = df.withColumn("h", F.rand(1) < 0.5).groupBy("k", "h").agg(*partial_totals(F.col("x"), "x"))
    assert dict(rows(halves.groupBy("k").agg(merged_total("x")))) == want
    tripled = halves.groupBy("k").agg(merged_total("x", F.lit(3)).alias("t"))
    assert dict(rows(tripled))["cents"] == 0.9


def test_totals_do_not_depend_on_the_order(spark):
    amounts = spark.range(20000).select((F.rand(7) * 1e6).alias("x"))
    cents = amounts.select(F.round("x", 2).alias("x"))
    sums = {cents.repartition(n).agg(total(F.col("x"))).first()[0] for n in (1, 3, 16)}
    assert len(sums) == 1


def test_left_join_keeps_every_bill(spark):
    bills = spark.createDataFrame([("A", "1"), ("A", "2"), (None, "1"), ("C", "1")], "`Dev Name` STRING, t STRING")
    members = spark.createDataFrame([("A", "1", "Q"), (None, "1", "X")], "name STRING, tds STRING, borough STRING")
    joined = join_members(bills, members, {"Dev Name": "name", "t": "tds"}, {"borough": "b"})
    assert rows(joined) == rows(
        spark.createDataFrame(
            [("A", "1", "Q"), ("A", "2", None), (None, "1", None), ("C", "1", None)], "`Dev Name` STRING, t STRING, b STRING"
        )
    )


def test_lookup_matches_null_attributes(spark):
    dim = spark.createDataFrame([(1, None, "Q"), (2, "x", "Q"), (3, None, None)], "k INT, zip STRING, borough STRING")
    facts = spark.createDataFrame([("Q",), (None,), ("Z",)], "b STRING")
    assert rows(lookup_key(facts, dim, "k", {"zip": None, "borough": "b"})) == [("Q", 1), ("Z", None), (None, 3)]
    with pytest.raises(ValueError):
        lookup_key(facts, dim, "k", {"zip": None, "borough": None})


def test_duplicates_and_orphans(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k INT, v STRING")
    facts = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "k INT")
    assert rows(checks.duplicate_keys(dim, ["k"])) == [(2, 2)]
    assert rows(checks.orphan_keys(facts, "k", dim)) == [(9, 2)]
    report = checks.foreign_key_report(facts, {"k": (dim, "k")})
    assert rows(report.select("key_column", "row_count", "null_keys", "orphan_rows")) == [("k", 5, 1, 2)]
    primary = checks.primary_key_report({"dim": (dim, ["k"]), "facts": (facts, ["k"]), "none": (dim.where("k > 5"), ["k"])})
    assert rows(primary) == [("dim", 3, 0, 1), ("facts", 5, 1, 2), ("none", 0, 0, 0)]


def test_null_report(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a INT, b STRING")
    assert rows(checks.null_report(df, {"a": True, "b": False})) == [("a", True, 2, 1), ("b", False, 2, 2)]


def test_contract_types(spark):
    contract = T.StructType(
        [T.StructField("amount", T.DecimalType(18, 2)), T.StructField("place", T.DecimalType(9, 6)), T.StructField("name", T.VarcharType(3))]
    )
    df = spark.createDataFrame(
        [(12.345, 1.5, "abc"), (1e17, 1000.0, "abcd"), (None, None, None)], "amount DOUBLE, place DOUBLE, name STRING"
    ).coalesce(1)
    fitted = checks.fit_contract(df, contract)
    assert [tuple(r) for r in fitted.collect()] == [
        (Decimal("12.35"), Decimal("1.500000"), "abc"),
        (None, None, None),
        (None, None, None),
    ]
    assert fitted.dtypes[0] == ("amount", "decimal(18,2)")
    assert rows(checks.misfit_report(df, contract)) == [("amount", 1), ("name", 1), ("place", 1)]


def staged(spark, bills):
    schema = (
        "BillDate_Std DATE, Bill_Year INT, Bill_Quarter INT, Bill_Month INT, Bill_Day INT, `Development Name` STRING, "
        "Borough STRING, `TDS #` STRING, `Consumption _KWH_` DOUBLE, `Current Charges` DOUBLE"
    )
    data = [(day, day.year, 1, day.month, day.day, *rest) for day, *rest in bills]
    return spark.createDataFrame(data, schema)


def test_rowgrain_totals_equal_the_join_they_stand_for(spark):
    days = [dt.date(2010 + i % 3, 1, 1 + i % 5) for i in range(300)]
    bills = [
        (day, None if i % 11 == 0 else f"D{i % 4 if i % 3 else 0}", f"B{i % 2}", None if i % 17 == 0 else "7", float(i), i / 4)
        for i, day in enumerate(days)
    ]
    staging = staged(spark, bills)
    dates = star.build_dim_date(staging)
    dim = staging.where("`Development Name` IS NOT NULL").select(
        F.col("Development Name").alias("n"), F.col("Borough").alias("b"), F.col("TDS #").alias("t")
    )
    on = (F.col("Development Name") == F.col("n")) & (F.col("Borough") == F.col("b")) & (F.col("TDS #") == F.col("t"))
    literal = staging.join(dim, on, "left").groupBy("Bill_Year", "b").agg(
        F.sum("Consumption _KWH_"), F.sum("Current Charges")
    )
    assert rows(star.usage_by_year_rowgrain(staging, dates)) == rows(literal)


def test_star_does_not_multiply_bills(spark):
    staging = staged(spark, [(dt.date(2010, 1, 1), "D", "B", "7", 10.0, 1.0), (dt.date(2010, 1, 2), "D", "B", "7", 20.0, 2.0)])
    twice = spark.createDataFrame([("D", "B", "7", "x"), ("D", "B", "7", "y")], "development_name STRING, Borough STRING, tds_number STRING, amp STRING")
    result = star.usage_by_year_star(staging, star.build_dim_date(staging), twice)
    assert rows(result) == [(2010, "B", 30.0, 3.0)] == rows(star.usage_by_year(staging))
