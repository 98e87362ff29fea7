"""Exact global median without bringing the values to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billmill.functions.text import col

# Cells per power of two in the first step and per first cell in the second. Doubles have 2**52 values
# per power of two, so a second cell holds at most 2**(52 - 9 - 20) = 2**23 distinct values, and the
# first step has at most 2 * 2100 * 2**9 cells: every window below has a bounded number of rows,
# whatever the size of the input.
_PER_OCTAVE = 2**9
_PER_CELL = 2**20
_OFFSET = 2000 * _PER_OCTAVE
_BEYOND = 1500.0  # above log2 of every finite double


def _log_cell(value: Column) -> Column:
    """A whole number that never falls as the value rises: the sign and the rounded logarithm.

    Never NULL, so that joins on it add no filter and all uses of the counts share one shuffle.
    """

    def size(positive: Column) -> Column:
        octave = F.least(F.log2(positive), F.lit(_BEYOND))
        return F.floor(octave * _PER_OCTAVE).cast("bigint") + _OFFSET

    signed = F.when(value > 0, size(value)).when(value < 0, -size(-value))
    return F.coalesce(signed, F.lit(0).cast("bigint"))


def _linear_cell(value: Column, low: Column, high: Column) -> Column:
    share = (value - low) / (high - low)
    inside = F.least(F.floor(share * _PER_CELL).cast("bigint"), F.lit(_PER_CELL - 1))
    return F.when(low < high, inside).otherwise(F.lit(0).cast("bigint"))


def _holding_the_middle(groups: DataFrame, order: list[str], before: Column) -> DataFrame:
    """The one or two groups (rows with a count ``n``) that hold the two middle ranks."""
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = groups.withColumn("last", before + F.sum("n").over(upto))
    return placed.where(
        (F.col("last") >= F.expr("(rows + 1) div 2"))
        & (F.col("last") - F.col("n") < F.expr("rows div 2 + 1"))
    )


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column ``median``: the middle value, or the mean of the two middle values.

    Equal values are counted before the only shuffle that grows with the data, so a hot value is one
    row per task. Two rounds of ever finer cells then find the few values around the middle rank.
    NULL and NaN are skipped; the median of nothing is NULL.
    """
    value = col(column).cast("double")
    counts = (
        df.where(value.isNotNull() & ~F.isnan(value))
        .groupBy(value.alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("cell", _log_cell(F.col("v")))
    )
    summary = [F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")]

    cells = counts.groupBy("cell").agg(*summary)
    cells = cells.withColumn("rows", F.sum("n").over(Window.partitionBy()))
    wide = _holding_the_middle(cells, ["cell"], F.lit(0)).select(
        "cell", "rows", "low", "high", (F.col("last") - F.col("n")).alias("before")
    )

    # At most two rows are broadcast: the two middle ranks lie in at most two cells.
    fine = (
        counts.join(F.broadcast(wide), "cell")
        .withColumn("part", _linear_cell(F.col("v"), F.col("low"), F.col("high")))
        .groupBy("cell", "part", "rows", "before")
        .agg(*summary)
    )
    start = F.min("before").over(Window.partitionBy())
    narrow = _holding_the_middle(fine.withColumn("before", start), ["cell", "part"], F.col("before"))
    narrow = narrow.select(
        "cell", "rows", "low", "high", (F.col("last") - F.col("n")).alias("before")
    )

    near = counts.join(F.broadcast(narrow), "cell").where(F.col("v").between(F.col("low"), F.col("high")))
    near = near.select("v", "n", "rows", F.min("before").over(Window.partitionBy()).alias("before"))
    middle = _holding_the_middle(near, ["v"], F.col("before"))
    return middle.agg(F.avg("v").alias("median"))


def flag_above(df: DataFrame, column: str, median: DataFrame, flag: str) -> DataFrame:
    """Add 1 where the column exceeds the one-row ``median``, else 0 (also where it is NULL)."""
    above = col(column) > median.scalar()
    return df.withColumn(flag, F.coalesce(above, F.lit(False)).cast("bigint"))
