"""Joins between staged bills and dimensions.

No broadcast hints: a dimension may grow with the data, so Spark compares its size with
``spark.sql.autoBroadcastJoinThreshold`` (again at run time, under AQE) and otherwise shuffles both
sides, where AQE splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmill.functions.text import col
from billmill.schema import STD_DATE


def join_bill_date(bills: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Bills with the key of their date; bills whose date is unknown to the dimension drop out."""
    dates = dim_date.select("bill_date", "date_key", F.col("Bill_Year").alias("bill_year"))
    return (
        bills.join(dates, col(STD_DATE) == F.col("bill_date"), "left")
        .where(F.col("bill_year").isNotNull())
        .drop("bill_date")
    )


def join_members(
    bills: DataFrame, members: DataFrame, on: Mapping[str, str], take: Mapping[str, str]
) -> DataFrame:
    """Left join on natural columns. Every bill stays; without a match the taken columns are NULL.

    ``on`` maps bill columns to member columns, ``take`` maps member columns to their new names. The
    members must be unique on their join columns (see ``checks.duplicate_keys``).
    """
    side = members.select(
        *[col(theirs).alias(f"_on_{i}") for i, theirs in enumerate(on.values())],
        *[col(theirs).alias(name) for theirs, name in take.items()],
    )
    match = reduce(and_, [col(ours) == F.col(f"_on_{i}") for i, ours in enumerate(on)])
    return bills.join(side, match, "left").drop(*[f"_on_{i}" for i in range(len(on))])


def lookup_key(
    facts: DataFrame, dimension: DataFrame, key: str, attributes: Mapping[str, str | None]
) -> DataFrame:
    """Add the dimension's ``key`` by its natural attributes; NULL where no member matches.

    ``attributes`` maps each attribute to the fact column that holds it, or to None where the facts
    have no such value. NULL attributes match NULL, as one member stands for them.
    """
    side = dimension.select(
        F.col(key).alias("_key"), *[col(name).alias(f"_is_{name}") for name in attributes]
    )
    equal = []
    for name, source in attributes.items():
        if source is None:
            side = side.where(F.col(f"_is_{name}").isNull())
        else:
            equal.append(col(source).eqNullSafe(F.col(f"_is_{name}")))
    if not equal:
        raise ValueError(f"{key}: the facts hold none of the natural attributes")
    match = reduce(and_, equal)
    return (
        facts.join(side, match, "left")
        .withColumn(key, F.col("_key"))
        .drop("_key", *[f"_is_{name}" for name in attributes])
    )
