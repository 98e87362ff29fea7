from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billmill.functions.text import col
from billmill.workspace import stored

# A whole number per row of a step: neighbours in a file have neighbouring numbers.
PLACE = "_place_in_step"
_BLOCK_BITS = 12  # 4,096 places, 64 words of 64 bits, make a row of bits
# So many rows of bits (half a billion places, 75 MB) are sent to every task; with more, the rows move to their bits.
MOST_SENT = 1 << 17


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in ``order``, which must be a total order of the rows.

    ``row_number() = 1`` makes Spark drop the later rows of a key inside each task before the shuffle
    (WindowGroupLimit), so even a key that holds a third of all rows sends at most one row per task.
    A total order makes the winner independent of partitioning and of recomputed tasks.
    """
    if not keys:
        return df
    first = Window.partitionBy(*[col(k) for k in keys]).orderBy(
        *[col(o).asc_nulls_first() for o in order]
    )
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def place_rows(df: DataFrame) -> DataFrame:
    """Add ``PLACE``, for a step that is stored at once: only what is stored keeps its numbers."""
    return df.withColumn(PLACE, F.monotonically_increasing_id())


def rows_at(df: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of a placed step whose places occur in ``places``, without their places.

    A bit is set per place, and the bits go to the rows: the rows, however wide, stay in the tasks that read them.
    """
    words = places.groupBy(F.shiftright(PLACE, 6).alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST({PLACE} & 63 AS INT))")).alias("_bits")
    )
    found = F.map_from_entries(F.collect_list(F.struct(F.expr("CAST(_word & 63 AS INT)"), "_bits")))
    blocks = words.groupBy(F.shiftright("_word", _BLOCK_BITS - 6).alias("_block")).agg(found.alias("_found"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("_found", i), F.lit(0).cast("bigint")))
    blocks = stored(blocks.select("_block", filled.alias("_words")), "place-bits")
    if blocks.count() <= MOST_SENT:
        blocks = F.broadcast(blocks)
    held = df.withColumn("_block", F.shiftright(PLACE, _BLOCK_BITS)).join(blocks, "_block")
    is_set = F.expr(f"bit_get(_words[CAST(shiftright({PLACE}, 6) & 63 AS INT)], CAST({PLACE} & 63 AS INT)) = 1")
    return held.where(is_set).select(*[col(name) for name in df.columns if name != PLACE])
