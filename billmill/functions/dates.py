from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from billmill.functions.text import quoted

# The format of the sales bills: 1/6/2010 and 01/06/2010 both match.
DATE_FORMAT = "M/d/yyyy"

# What a bill file may hold, in the order in which a first date is tried: a day that can be a month is one.
_DAYS = (
    "M/d/yyyy",
    "d/M/yyyy",
    "yyyy-M-d",
    "yyyy/M/d",
    "M-d-yyyy",
    "d-M-yyyy",
    "M.d.yyyy",
    "d.M.yyyy",
    "yyyyMMdd",
    "MMMM d, yyyy",
    "MMM d, yyyy",
    "d MMMM yyyy",
    "d MMM yyyy",
    "d-MMM-yyyy",
    "M/d/yy",
)
_TIMES = ("", " H:mm", " H:mm:ss", "'T'H:mm:ss", " h:mm:ss a", " H:mm:ss.S", " H:mm:ss.SSS", "'T'H:mm:ss.SSS")
DATE_FORMATS = tuple(day + time for time in _TIMES for day in _DAYS)


def _literal(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def parse_date(name: str, date_format: str | Sequence[str] = DATE_FORMAT) -> Column:
    """The text column as DATE; NULL for text that is no such day (02/30 included), also under ANSI.

    Of several formats the first that fits counts, for each text by itself. Days that 64-bit nanoseconds cannot
    hold (before 1677 or after 2262, such as 12/31/9999) are NULL too: they are placeholders, no bill dates. The
    multiplication overflows to NULL exactly there.
    """
    if isinstance(date_format, str):
        moment = f"try_to_timestamp({quoted(name)}, {_literal(date_format)})"
    else:
        tried = ", ".join(_literal(one) for one in date_format)
        moments = f"transform(array({tried}), f -> try_to_timestamp({quoted(name)}, f))"
        moment = f"get(filter({moments}, m -> m IS NOT NULL), 0)"
    nanoseconds = f"try_multiply(unix_micros({moment}), 1000L)"
    return F.expr(f"CAST(timestamp_micros({nanoseconds} div 1000) AS DATE)")


def matching_format(spark: SparkSession, text: str, formats: Sequence[str] = DATE_FORMATS) -> str | None:
    """The first of ``formats`` that reads ``text`` as a day."""
    row = spark.range(1).select(F.lit(text).alias("text"))
    days = row.select(*[parse_date("text", one).alias(f"d{i}") for i, one in enumerate(formats)]).first()
    return next((one for one, day in zip(formats, days) if day is not None), None)


def date_key(day: Column) -> Column:
    """2025-01-15 -> 20250115, by arithmetic so that it stays in generated code."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5
