from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billmill.functions.text import col
from billmill.sources.files import Files
from billmill.workspace import stored_at

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in the lower 33 bits
RANGE_BYTES = 256 << 20
RANGE_ROWS = 1 << 20
# Rows make up to so many ranges (17 billion rows); beyond that the bytes alone do.
MOST_BY_ROWS = 1 << 14


def n_ranges(stored_bytes: int, range_bytes: int = RANGE_BYTES, rows: int = 0) -> int:
    """How many ranges a stored table is numbered in: as many as its bytes fill, or its rows if these fill more.

    Columns of few values are stored in next to nothing, but their rows are shuffled and sorted at full width.
    """
    by_rows = min(-(-rows // RANGE_ROWS), MOST_BY_ROWS)
    return max(1, -(-stored_bytes // range_bytes), by_rows)


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    key: str,
    key_type: str = "bigint",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Add ``key`` = 1, 2, 3, ... in the given order, NULLs first, without one task seeing all rows.

    Same numbers as ``row_number()`` over a window without partitions. The rows are stored, split by range and
    sorted in parallel, and each range starts after the rows of the ranges before it. The number of ranges follows
    from the bytes and rows stored, not from the session's settings. ``order`` should be a total order: then reruns give the
    same keys. Rows that are equal in ``order`` are split over several ranges all the same, by all their columns and
    then by their place in the stored table, so a value that a third of all rows share is no hot range; which of
    such rows comes first is only defined as far as their other columns differ.

    The placed rows are written to the shared folder, so the offsets and the keys come from the very same
    ranges even if an executor is lost, and the counts read one column. The offsets are one row per range, few
    enough to broadcast.
    """
    return number_stored(*stored_at(df, "unnumbered"), order, key, key_type, range_bytes)


def number_stored(
    rows: DataFrame,
    folder: str,
    order: Sequence[str],
    key: str,
    key_type: str = "bigint",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``number_rows`` for rows that a step has stored in ``folder``."""
    ranges = n_ranges(Files(rows.sparkSession).size(folder), range_bytes, rows.count())
    settled = F.struct(F.xxhash64(*[col(name) for name in rows.columns]), F.monotonically_increasing_id())
    by = [*[col(name).asc_nulls_first() for name in order], F.col("_tie").asc()]
    placed = (
        rows.withColumn("_tie", settled)
        .repartitionByRange(ranges, *by)
        .sortWithinPartitions(*by)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_at", _ROW_BITS))
    )
    placed, _ = stored_at(placed, "numbered")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn("_key", (F.col("_before") + within + 1).cast(key_type))
        .select(F.col("_key").alias(key), *[col(name) for name in rows.columns])
    )
