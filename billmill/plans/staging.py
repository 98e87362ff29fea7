"""From raw bills to one clean row per bill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billmill.functions.dates import DATE_FORMAT, DATE_FORMATS, matching_format
from billmill.functions.text import col, null_if_na
from billmill.operators.clean import (
    DATED,
    MARKED_STAGE,
    MEASURED,
    add_daily_ratios,
    add_unit_cost,
    coerce_measures,
    drop_undated,
    fill_unknown,
    is_marked,
    mark_bills,
    marks,
    null_na_tokens,
    parse_bill_date,
    present,
    read_marks,
)
from billmill.operators.dedup import PLACE, keep_first, rows_at
from billmill.operators.median import exact_median, flag_above
from billmill.schema import BILL_DATE, DIMENSIONS, DUPLICATE_KEYS, KWH, MEASURES, STAGING_RENAMES, STD_DATE
from billmill.sources.bill_files import FILE_ORDER
from billmill.workspace import stored


_LISTED = (BILL_DATE, *DIMENSIONS, *MEASURES)


def infer_date_format(raw: DataFrame, order: Sequence[str] = FILE_ORDER) -> str | Sequence[str]:
    """The format of the first bill date in ``order``, for all bills; all known formats, each text by itself, if the
    first one is no date in any of them.

    One narrow pass over the dates: the smallest place per task, one row in the end.
    """
    place = F.struct(*[col(name) for name in order])
    texts = raw.select(null_if_na(BILL_DATE).alias("text"), place.alias("place")).where("text is not null")
    return date_format_of(raw.sparkSession, texts.agg(F.min_by("text", "place")).first()[0])


def date_format_of(spark: SparkSession, text: str | None) -> str | Sequence[str]:
    found = matching_format(spark, text) if text is not None else None
    return found or DATE_FORMATS


def clean_bills(
    raw: DataFrame, order: Sequence[str] = FILE_ORDER, date_format: str | Sequence[str] = DATE_FORMAT
) -> DataFrame:
    """The row-level steps: no shuffle. Blanks become members of a key before keys are compared.

    Only unlisted columns need the token step: filling covers the dimensions, and no token parses as a
    day or a number. Marked bills are not parsed again.
    """
    if is_marked(raw):
        return raw.transform(null_na_tokens, (*order, *_LISTED)).transform(read_marks).transform(fill_unknown)
    return (
        raw.transform(null_na_tokens, (*order, *_LISTED))
        .transform(parse_bill_date, date_format)
        .transform(drop_undated)
        .transform(fill_unknown)
        .transform(coerce_measures)
    )


def first_bills(clean: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """The first bill with a measure per date, development and meter (those of them the input has).

    Bills without any measure must not win over a later copy, so they rank last, and a key that has no
    other bill is dropped afterwards. Dropping them before (``drop_empty_measures``) gives the same rows,
    but Spark would move that filter below the parsing and parse every measure twice.
    """
    measures = present(clean, MEASURES)
    if not measures:
        return keep_first(clean, present(clean, DUPLICATE_KEYS), order)
    empty = F.coalesce(*[col(name) for name in measures]).isNull()
    ranked = keep_first(
        clean.withColumn("_empty", empty), present(clean, DUPLICATE_KEYS), ("_empty", *order)
    )
    return ranked.where(~F.col("_empty")).drop("_empty")


def add_metrics(bills: DataFrame) -> DataFrame:
    """Daily ratios, unit cost and the flag for usage above the median of all kept bills."""
    bills = bills.transform(add_daily_ratios).transform(add_unit_cost)
    if KWH not in bills.columns:
        return bills
    return flag_above(bills, KWH, exact_median(bills, KWH), "HighUsageFlag")


def staged_bills(
    raw: DataFrame, order: Sequence[str] = FILE_ORDER, date_format: str | Sequence[str] = DATE_FORMAT
) -> DataFrame:
    """The stored first bills, with their place in ``order``. Marked bills are read as they are.

    Bills of a placed step (``place_rows``) stay where they are: what decides on them is read alone and moves, and the
    other columns are read of the bills that stay.
    """
    if PLACE not in raw.columns:
        return stored(clean_bills(raw, order, date_format).transform(first_bills, order), "first-bills")
    read = [*present(raw, [BILL_DATE, *DUPLICATE_KEYS, *MEASURES]), *marks(raw), *order, PLACE]
    deciding = clean_bills(raw.select(*[col(name) for name in dict.fromkeys(read)]), order, date_format)
    kept = rows_at(raw, first_bills(deciding, order).select(PLACE))
    return stored(clean_bills(kept, order, date_format), "first-bills")


def build_staging(
    raw: DataFrame, order: Sequence[str] = FILE_ORDER, date_format: str | Sequence[str] = DATE_FORMAT
) -> DataFrame:
    """The whole way. The first bills are stored once, so that the raw bills are parsed and deduplicated
    once; the median then reads one stored column, and the metrics are added on the way to the reader.
    """
    return add_metrics(staged_bills(raw, order, date_format).drop(*order))


def staging_names(df: DataFrame) -> DataFrame:
    """Rename the columns whose names a table cannot hold."""
    return df.withColumnsRenamed(STAGING_RENAMES)


def stage_counts(
    raw: DataFrame,
    staged: DataFrame,
    order: Sequence[str] = FILE_ORDER,
    date_format: str | Sequence[str] = DATE_FORMAT,
) -> DataFrame:
    """One row per stage: its rows and columns. ``staged`` is counted as it is stored.

    The marks that landing has written beside the rows say which stage each bill reaches, so one short column is
    read and no text is parsed again. They are counted from the committed files: a task that runs again, before or
    after, changes nothing. Bills without marks are marked (parsed) here.
    """
    marked = raw if is_marked(raw) else mark_bills(raw, date_format)
    stage = F.col(MARKED_STAGE)
    counts = marked.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(stage >= DATED).alias("dated"),
        F.count_if(stage >= MEASURED).alias("measured"),
    )
    counts = counts.withColumn("staged", staged.agg(F.count(F.lit(1))).scalar())

    given = [name for name in raw.columns if name not in {*order, *marks(raw)}]
    clean = raw.select(*[col(name) for name in given]).limit(0).transform(parse_bill_date).transform(coerce_measures)
    n_clean = len(clean.columns)
    derived = clean.transform(add_daily_ratios).transform(add_unit_cost).columns
    stages = {"raw": len(given), "dated": n_clean, "measured": n_clean, "staged": len(derived) + (KWH in derived)}
    lines = [
        F.struct(
            F.lit(place).alias("place"),
            F.lit(stage).alias("stage"),
            F.col(stage).alias("row_count"),
            F.lit(width).cast("bigint").alias("column_count"),
        )
        for place, (stage, width) in enumerate(stages.items(), 1)
    ]
    return counts.select(F.inline(F.array(*lines)))
