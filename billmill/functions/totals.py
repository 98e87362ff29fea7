"""Sums of doubles that do not depend on the order in which tasks finish.

Adding doubles in another order changes the last digits, so a plain SUM over a shuffle is not
reproducible. Amounts that six decimals hold exactly (all money and meter readings) are added as
decimals. The rest (huge, infinite or finer than six decimals) is added as doubles beside them, so no
amount is lost or rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(18,6)"


def exact_part(amount: Column) -> Column:
    as_decimal = amount.try_cast(_EXACT)
    return F.when(as_decimal.cast("double") == amount, as_decimal)


def wide_part(amount: Column) -> Column:
    return F.when(exact_part(amount).isNull(), amount)


def join_parts(exact: Column, wide: Column) -> Column:
    """One double from the two sums; NULL only if both are."""
    exact = exact.cast("double")
    return F.when(wide.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + wide)


def total(amount: Column) -> Column:
    """Aggregate: the sum of one group, NULLs skipped, NULL for a group without amounts."""
    return join_parts(F.sum(exact_part(amount)), F.sum(wide_part(amount)))


def partial_totals(amount: Column, name: str) -> list[Column]:
    """Aggregates for a first level of grouping; ``merged_total`` finishes them."""
    return [
        F.sum(exact_part(amount)).alias(f"{name}__exact"),
        F.sum(wide_part(amount)).alias(f"{name}__wide"),
    ]


def merged_total(name: str, copies: Column | None = None) -> Column:
    """Aggregate over ``partial_totals`` rows, each counted ``copies`` times (once by default)."""
    exact, wide = F.col(f"{name}__exact"), F.col(f"{name}__wide")
    if copies is not None:
        exact, wide = exact * copies, wide * copies
    return join_parts(F.sum(exact), F.sum(wide))
