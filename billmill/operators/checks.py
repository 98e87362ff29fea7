"""Checks that stand in for the constraints a data warehouse table declares.

Each check pre-aggregates inside the tasks, so hot keys cost one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billmill.functions.text import col
from billmill.workspace import stored


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows. Empty for a proper key."""
    return (
        df.groupBy(*[col(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def orphan_keys(facts: DataFrame, key: str, dimension: DataFrame) -> DataFrame:
    """The non-NULL keys of the facts that the dimension lacks, with their number of rows."""
    used = facts.where(col(key).isNotNull()).groupBy(col(key)).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(dimension.select(col(key)), key, "left_anti")


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- Keys that are whole numbers ------------------------------------------------------------------
#
# Surrogate keys are dense, so 64 neighbouring keys share one 64-bit number: a bit says that the key occurs. The bits
# are set inside the tasks and merged per number, which moves a row per 64 keys instead of one per key. Counts beside
# the bits show in which few numbers keys repeat or lack a member; only the keys of these are counted one by one.

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


_WORD = "shiftright(key, 6)"
_BIT = "shiftleft(1L, CAST(pmod(key, 64) AS INT))"


def _key_words(rows: DataFrame) -> DataFrame:
    """name, word, ours, theirs, n: bits of the keys of both sides and the rows of ours, from name, key, member."""
    none = F.lit(0).cast("bigint")
    return (
        rows.withColumns({"word": F.expr(_WORD), "bit": F.expr(_BIT)})
        .groupBy("name", "word")
        .agg(
            F.coalesce(F.bit_or(F.when(~F.col("member"), F.col("bit"))), none).alias("ours"),
            F.coalesce(F.bit_or(F.when(F.col("member"), F.col("bit"))), none).alias("theirs"),
            F.count_if(~F.col("member")).alias("n"),
        )
    )


def _named_keys(df: DataFrame, keys: Mapping[str, str], member: bool) -> DataFrame:
    """name, key, member: one row per row of ``df`` and entry of ``keys`` (name -> column)."""
    pairs = [F.struct(F.lit(name).alias("name"), col(key).cast("bigint").alias("key")) for name, key in keys.items()]
    return df.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*", F.lit(member).alias("member"))


def _counted_one_by_one(rows: DataFrame, words: DataFrame) -> DataFrame:
    """name, word, key and its rows, for the words given; no job reads the rows if there are none."""
    asked = rows.where(~F.col("member")).withColumn("word", F.expr(_WORD))
    asked = asked.join(words.select("name", "word"), ["name", "word"], "left_semi")
    return asked.groupBy("name", "word", "key").agg(F.count(F.lit(1)).alias("n"))


def _whole_key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``primary_key_report`` for tables with one key column of whole numbers."""
    rows = _stack([_named_keys(df, {name: key}, False) for name, (df, key) in tables.items()])
    words = stored(_key_words(rows), "key-words")
    repeated = words.where(F.col("word").isNotNull() & (F.col("n") > F.bit_count("ours")))
    single = words.select(
        "name", F.col("n"), F.when(F.col("word").isNull(), F.col("n")).otherwise(0).alias("nulls"), F.lit(0).cast("bigint").alias("twice")
    )
    none = F.lit(0).cast("bigint")
    counted = _counted_one_by_one(rows, repeated).where(F.col("n") > 1)
    twice = counted.select("name", none.alias("n"), none.alias("nulls"), F.lit(1).cast("bigint").alias("twice"))
    names = rows.sparkSession.createDataFrame([(name, 0, 0, 0) for name in tables], "name string, n long, nulls long, twice long")
    return single.unionByName(twice).unionByName(names).groupBy(F.col("name").alias("table_name")).agg(
        F.sum("n").alias("row_count"), F.sum("nulls").alias("null_keys"), F.sum("twice").alias("duplicate_keys")
    )


def _any_key_report(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
    per_key = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if((F.col("_n") > 1) & ~missing).alias("duplicate_keys"),
    ).select(F.lit(name).alias("table_name"), "row_count", "null_keys", "duplicate_keys")


def primary_key_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: its rows, rows without a key, and keys that occur more than once.

    All tables with a whole number as key are checked together, by the bits of their keys.
    """
    whole = {
        name: (df, keys[0])
        for name, (df, keys) in tables.items()
        if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, _WHOLE)
    }
    parts = [_any_key_report(name, df, keys) for name, (df, keys) in tables.items() if name not in whole]
    return _stack([*([_whole_key_report(whole)] if whole else []), *parts])


def foreign_key_report(facts: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per foreign key: fact rows, rows without a key, rows whose key has no member.

    The facts are read once for all keys; keys are whole numbers. Their bits meet the bits of the members. Where a
    number holds fact keys with and without a member, and only there, its keys are counted one by one.
    """
    used = _named_keys(facts, {key: key for key in dimensions}, False)
    members = [_named_keys(dim, {key: their}, True).where("key is not null") for key, (dim, their) in dimensions.items()]
    words = stored(_key_words(_stack([used, *members])), "key-words")
    lacking = F.col("ours").bitwiseAND(F.bitwise_not("theirs"))
    words = words.withColumn("lacking", lacking).where("n > 0")
    mixed = words.where((F.col("lacking") != 0) & (F.col("lacking") != F.col("ours")))
    orphans = F.when(F.col("word").isNull() | (F.col("lacking") != F.col("ours")), 0).otherwise(F.col("n"))
    sure = words.select(
        "name", "n", F.when(F.col("word").isNull(), F.col("n")).otherwise(0).alias("nulls"), orphans.cast("bigint").alias("orphans")
    )
    none = F.lit(0).cast("bigint")
    one_by_one = _counted_one_by_one(used, mixed).join(mixed.select("name", "word", "lacking"), ["name", "word"])
    one_by_one = one_by_one.where(F.col("lacking").bitwiseAND(F.expr(_BIT)) != 0)
    found = one_by_one.select("name", none.alias("n"), none.alias("nulls"), F.col("n").alias("orphans"))
    return sure.unionByName(found).groupBy(F.col("name").alias("key_column")).agg(
        F.sum("n").alias("row_count"), F.sum("nulls").alias("null_keys"), F.sum("orphans").alias("orphan_rows")
    )


def null_report(df: DataFrame, required: Mapping[str, bool]) -> DataFrame:
    """One row per column: whether it is required, its rows and its NULLs, all in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(col(name).isNull()).alias(name) for name in required],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(must).alias("required"),
                F.col("_rows").alias("row_count"),
                col(name).alias("null_count"),
            )
            for name, must in required.items()
        ]
    )
    return counts.select(F.inline(lines))


def fit_contract(df: DataFrame, contract: T.StructType, strict: bool = False) -> DataFrame:
    """Project to the contract's columns and types; values that do not fit become NULL.

    Decimals are rounded to their scale and NULL when too large. Text longer than its VARCHAR is NULL,
    not cut. ``misfit_report`` counts both, so a load can be refused before it loses anything; ``strict``
    fails at the first such value, as a declared column would.
    """

    def fitted(field: T.StructField):
        value = col(field.name)
        if isinstance(field.dataType, T.VarcharType):
            fits = F.when(F.length(value) <= field.dataType.length, value)
        else:
            fits = value.try_cast(field.dataType)
        if strict:
            lost = value.isNotNull() & fits.isNull()
            said = F.concat(F.lit(f"{field.name} does not fit its column: "), value.cast("string"))
            fits = F.when(lost, F.raise_error(said).cast(fits_type(field))).otherwise(fits)
        return fits.alias(field.name)

    def fits_type(field: T.StructField):
        return T.StringType() if isinstance(field.dataType, T.VarcharType) else field.dataType

    return df.select(*[fitted(field) for field in contract if field.name in df.columns])


def misfit_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per contract column: the non-NULL values that ``fit_contract`` could not keep."""
    names = [field.name for field in contract if field.name in df.columns]
    fields = [field for field in contract if field.name in names]
    both = fit_contract(df.withColumns({f"_was_{n}": col(n) for n in names}), T.StructType(
        [*fields, *[T.StructField(f"_was_{n}", df.schema[n].dataType) for n in names]]
    ))
    counts = both.agg(
        *[F.count_if(col(f"_was_{n}").isNotNull() & col(n).isNull()).alias(n) for n in names]
    )
    lines = [F.struct(F.lit(n).alias("column_name"), col(n).alias("misfits")) for n in names]
    return counts.select(F.inline(F.array(*lines)))
