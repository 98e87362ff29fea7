from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billmill.functions.text import quoted

INFINITY = float("inf")
# Spark's cast also takes Java literals (5d, 5f, 0x1p3) and NaN; none of them is a number here. The signs in texts such
# as n/a and 1,234 are in none either: the cast would find that out by a Java exception per text.
_NO_NUMBER = "[dDxX,/#]|[0-9.][fF]|[nN][aA]"
_SPELLED_OUT = "[nN]"  # inf and infinity hold it, 1e400 does not


def cast_number(name: str) -> Column:
    """First half of parsing: the text column as DOUBLE, Infinity for numbers that are too large."""
    text = f"CAST({quoted(name)} AS STRING)"
    return F.expr(f"TRY_CAST(IF({text} RLIKE '{_NO_NUMBER}', NULL, {text}) AS DOUBLE)")


def accept_number(name: str, cast: str) -> Column:
    """Second half: Infinity stays only where the text spells it out; 1e400 is no number."""
    number = quoted(cast)
    too_large = f"abs({number}) = DOUBLE('Infinity') AND NOT CAST({quoted(name)} AS STRING) RLIKE '{_SPELLED_OUT}'"
    return F.expr(f"IF({too_large}, NULL, {number})")


def parse_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace the text columns by DOUBLE columns, NULL for anything that is no plain number.

    Two projections, so that each text is cast once. The expressions are short on purpose: with all bill
    columns, the generated method must stay below the size up to which Java compiles methods.
    """
    casts = {name: f"_cast_{i}" for i, name in enumerate(names)}
    return (
        df.withColumns({cast: cast_number(name) for name, cast in casts.items()})
        .withColumns({name: accept_number(name, cast) for name, cast in casts.items()})
        .drop(*casts.values())
    )


def per_day(amount: Column, days: Column) -> Column:
    """amount / days with IEEE results for zero days: +-Infinity, and NULL for 0/0."""
    by_zero = F.when(amount > 0, INFINITY).when(amount < 0, -INFINITY)
    quotient = F.when(days == 0, by_zero).otherwise(F.try_divide(amount, days))
    return F.nanvl(quotient, F.lit(None).cast("double"))


def unit_cost(charges: Column, usage: Column) -> Column:
    """charges / usage, NULL where the quotient is not finite."""
    quotient = F.try_divide(charges, usage)
    return F.when(F.abs(quotient) < INFINITY, quotient)
