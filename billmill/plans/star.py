"""The star schema over staging (with staging names, see ``staging.staging_names``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmill.functions.dates import date_key
from billmill.functions.text import col
from billmill.functions.totals import merged_total, partial_totals, total
from billmill.operators.clean import present
from billmill.operators.joins import join_bill_date, join_members
from billmill.operators.keys import number_rows
from billmill.schema import (
    CALENDAR_PARTS,
    CHARGES,
    DIM_DEVELOPMENT,
    DIM_METER,
    DIM_VENDOR,
    MEASURES,
    STAGED_KWH,
    STD_DATE,
)

# Staging column -> dimension column of the natural key that joins bills to developments.
DEVELOPMENT_KEY = {
    "Development Name": "development_name",
    "Borough": "Borough",
    "TDS #": "tds_number",
}


def build_dim_date(staging: DataFrame) -> DataFrame:
    day = col(STD_DATE)
    return (
        staging.where(day.isNotNull())
        .select(date_key(day).alias("date_key"), day.alias("bill_date"), *CALENDAR_PARTS)
        .distinct()
    )


def dates_of(clean: DataFrame) -> DataFrame:
    """The date dimension from clean bills that are not deduplicated yet.

    Deduplication keeps a bill of every date that has one with a measure, so the dates are the same. Marking the dates
    inside the tasks leaves a row per date and task to move.
    """
    measures = present(clean, MEASURES)
    filled = F.coalesce(*[col(name) for name in measures]).isNotNull() if measures else F.lit(True)
    dates = clean.groupBy(col(STD_DATE), *CALENDAR_PARTS).agg(F.max(filled).alias("_filled")).where("_filled")
    return build_dim_date(dates.drop("_filled"))


def _attributes(staging: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    named = next(iter(columns))
    return staging.where(col(named).isNotNull()).select(
        *[col(source).alias(name) for source, name in columns.items()]
    )


def build_dimension(staging: DataFrame, columns: Mapping[str, str], key: str) -> DataFrame:
    """One row per distinct member, keys in the order of all attributes and so the same on reruns."""
    members = _attributes(staging, columns).distinct()
    return number_rows(members, list(columns.values()), key)


def build_dim_development(staging: DataFrame) -> DataFrame:
    return build_dimension(staging, DIM_DEVELOPMENT, "development_key")


def build_dim_meter(staging: DataFrame) -> DataFrame:
    return build_dimension(staging, DIM_METER, "meter_key")


def build_dim_vendor(staging: DataFrame) -> DataFrame:
    return build_dimension(staging, DIM_VENDOR, "vendor_key")


def build_rowgrain_dimension(
    staging: DataFrame, columns: Mapping[str, str], key: str, rank_by: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per bill, numbered by ``rank_by``: what numbering before DISTINCT amounts to.

    Kept for comparing with warehouses built that way. ``order`` settles ties.
    """
    bills = staging.where(col(next(iter(columns))).isNotNull()).select(
        *[col(source).alias(name) for source, name in columns.items()], *[col(o) for o in order]
    )
    return number_rows(bills, [*rank_by, *order], key).drop(*order)


def usage_by_year(staging: DataFrame) -> DataFrame:
    """Total usage and charges by year and borough, straight from the bills."""
    return (
        staging.where(F.col("Bill_Year").isNotNull())
        .select(
            F.col("Bill_Year").cast("bigint").alias("bill_year"),
            F.col("Borough").alias("borough"),
            col(STAGED_KWH).alias("kwh"),
            col(CHARGES).alias("charges"),
        )
        .groupBy("bill_year", "borough")
        .agg(
            total(F.col("kwh")).alias("total_kwh"),
            total(F.col("charges")).alias("total_current_charges"),
        )
    )


def _totals_per_member(staging: DataFrame) -> DataFrame:
    """Bills summed per date and development key, before any join: hot developments shrink here."""
    return staging.groupBy(col(STD_DATE), *[col(c) for c in DEVELOPMENT_KEY]).agg(
        F.count(F.lit(1)).alias("bills"),
        *partial_totals(col(STAGED_KWH), "kwh"),
        *partial_totals(col(CHARGES), "charges"),
    )


def _by_year(joined: DataFrame, copies=None) -> DataFrame:
    return joined.groupBy(F.col("bill_year").cast("bigint").alias("bill_year"), "borough").agg(
        merged_total("kwh", copies).alias("total_kwh"),
        merged_total("charges", copies).alias("total_current_charges"),
    )


def usage_by_year_star(staging: DataFrame, dim_date: DataFrame, dim_development: DataFrame) -> DataFrame:
    """The same totals through the date and development dimensions.

    The development dimension may hold one natural key several times (with other attributes), so it is
    reduced to its join columns first; otherwise each copy would count every bill again.
    """
    members = dim_development.select(*DEVELOPMENT_KEY.values()).distinct()
    joined = join_bill_date(_totals_per_member(staging), dim_date)
    joined = join_members(joined.withColumnRenamed("Borough", "_bill_borough"), members, {
        "Development Name": "development_name", "_bill_borough": "Borough", "TDS #": "tds_number",
    }, {"Borough": "borough"})
    return _by_year(joined)


def usage_by_year_rowgrain(staging: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The totals a join with the row-grain development dimension gives: each bill counts once per
    bill of its development.

    That join would emit the square of the largest group. The copies of a bill are just the size of its
    group, so multiplying the group totals by it gives the same sums from a handful of rows.
    """
    grouped = _totals_per_member(staging)
    sizes = (
        grouped.where(col("Development Name").isNotNull())
        .groupBy(*[col(c) for c in DEVELOPMENT_KEY])
        .agg(F.sum("bills").alias("members"))
    )
    joined = join_bill_date(grouped, dim_date)
    joined = join_members(
        joined.withColumnRenamed("Borough", "_bill_borough"),
        sizes,
        {"Development Name": "Development Name", "_bill_borough": "Borough", "TDS #": "TDS #"},
        {"Borough": "borough", "members": "members"},
    )
    return _by_year(joined, F.coalesce(F.col("members"), F.lit(1)))


def preview(table: DataFrame, by: str, rows: int = 20) -> DataFrame:
    """The first rows by a column: a top-k per task, never a full sort."""
    return table.orderBy(col(by).asc_nulls_first()).limit(rows)
