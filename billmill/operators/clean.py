"""Row-level cleaning. None of these steps shuffles; Catalyst fuses them into one scan stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billmill.functions.dates import DATE_FORMAT, parse_date
from billmill.functions.numbers import parse_numbers, per_day, unit_cost
from billmill.functions.text import col, member_or, null_if_na
from billmill.schema import (
    BILL_DATE,
    CHARGES,
    DAYS,
    DIMENSIONS,
    KWH,
    MEASURES,
    STD_DATE,
    UNKNOWN,
)


def present(df: DataFrame, names: list[str]) -> list[str]:
    """Those of ``names`` that the input has; optional columns are decided while planning."""
    return [name for name in names if name in df.columns]


def null_na_tokens(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn the no-value spellings into NULL in every text column but those in ``keep``."""
    texts = [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in keep
    ]
    return df.withColumns({name: null_if_na(name) for name in texts})


def parse_bill_date(df: DataFrame, date_format: str | Sequence[str] = DATE_FORMAT) -> DataFrame:
    """Parse the required bill date in place and add its standard form and calendar parts."""
    if BILL_DATE not in df.columns:
        raise ValueError(f"the bills have no column {BILL_DATE!r}")
    return _dated(df.withColumn(STD_DATE, parse_date(BILL_DATE, date_format)))


def _dated(df: DataFrame) -> DataFrame:
    day = col(STD_DATE)
    return (
        df.withColumn(BILL_DATE, day)
        .withColumns(
            {
                "Bill_Year": F.year(day),
                "Bill_Quarter": F.quarter(day),
                "Bill_Month": F.month(day),
                "Bill_Day": F.dayofmonth(day),
            }
        )
    )


def drop_undated(df: DataFrame) -> DataFrame:
    return df.where(col(STD_DATE).isNotNull())


def fill_unknown(df: DataFrame) -> DataFrame:
    """Give rows without a dimension value (NULL or a no-value spelling) the member "Unknown"."""
    return df.withColumns({name: member_or(name, UNKNOWN) for name in present(df, DIMENSIONS)})


def coerce_measures(df: DataFrame) -> DataFrame:
    return parse_numbers(df, present(df, MEASURES))


# What a bill was found to hold when it was landed: its day, its measures, and the stage that it reaches.
MARKED_DAY, MARKED_STAGE = "_day", "_stage"
UNDATED, DATED, MEASURED = 0, 1, 2


def marked_measure(name: str) -> str:
    return f"_measure_{MEASURES.index(name)}"


def mark_bills(df: DataFrame, date_format: str | Sequence[str] = DATE_FORMAT) -> DataFrame:
    """Add the parsed day and measures beside the texts, and the stage that the bill reaches.

    Bills are parsed here once, on their way into the raw zone; staging and stage counts read what is written there.
    """
    if BILL_DATE not in df.columns:
        raise ValueError(f"the bills have no column {BILL_DATE!r}")
    measures = present(df, MEASURES)
    texts = {marked_measure(name): col(name) for name in measures}
    marked = parse_numbers(df.withColumn(MARKED_DAY, parse_date(BILL_DATE, date_format)).withColumns(texts), list(texts))
    measured = F.coalesce(*[F.col(name) for name in texts]).isNotNull() if texts else F.lit(True)
    stage = F.when(F.col(MARKED_DAY).isNull(), UNDATED).when(measured, MEASURED).otherwise(DATED)
    return marked.withColumn(MARKED_STAGE, stage.cast("tinyint"))


def is_marked(df: DataFrame) -> bool:
    return MARKED_STAGE in df.columns


def marks(df: DataFrame) -> list[str]:
    """The columns that ``mark_bills`` has added."""
    return [name for name in (MARKED_DAY, MARKED_STAGE, *map(marked_measure, MEASURES)) if name in df.columns]


def read_marks(df: DataFrame) -> DataFrame:
    """The bills with a day and a measure, both as they were parsed on landing."""
    measures = {name: F.col(marked_measure(name)) for name in present(df, MEASURES)}
    kept = df.where(F.col(MARKED_STAGE) == MEASURED).withColumn(STD_DATE, F.col(MARKED_DAY))
    return _dated(kept).withColumns(measures).drop(*marks(df))


def drop_empty_measures(df: DataFrame) -> DataFrame:
    """Drop rows in which every measure the input has is missing."""
    measures = present(df, MEASURES)
    if not measures:
        return df
    return df.where(F.coalesce(*[col(name) for name in measures]).isNotNull())


def add_daily_ratios(df: DataFrame) -> DataFrame:
    added = {}
    if {KWH, DAYS} <= set(df.columns):
        added["Avg_Daily_kWh"] = per_day(col(KWH), col(DAYS))
    if {CHARGES, DAYS} <= set(df.columns):
        added["Avg_Daily_Current_Charges"] = per_day(col(CHARGES), col(DAYS))
    return df.withColumns(added) if added else df


def add_unit_cost(df: DataFrame) -> DataFrame:
    if not {CHARGES, KWH} <= set(df.columns):
        return df
    return df.withColumn("Cost_per_kWh", unit_cost(col(CHARGES), col(KWH)))
