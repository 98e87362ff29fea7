"""Exact deduplication by skew-safe combining, on built-in functions only.

Texts are equal when they are identical after every run of white space became one space. Copies are combined in
three stages, each of which compares whole texts, not digests alone: inside each task (the partial aggregation),
per digest and salt, and per digest over its salts. A text that a third of all rows hold is one row per task, then
one row per salt, then one row. Afterwards a digest with one text stands for this text, and rows learn their group
by digest; a digest with several texts (no two are known for SHA-256) is resolved by text once more.

A null text counts as empty; a text of white space only is one space and no copy of an empty one. Of equal texts the
row with the smallest doc_id stays; rows without doc_id come last, and of rows that repeat the smallest doc_id one
stays (which of them is not defined, they differ in no column of the result). An empty table gives an empty result.
A very long text is one value of one row, as in the table itself. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billmill.llm.steps import stored

SALTS = 64
# Groups of at least one in so many of all rows are met by broadcast: there are at most so many of them.
HOT_SHARE = 10_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def combine(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """digest, text, ``keep_id`` and ``n``: one row per distinct text of ``rows`` (doc_id, digest, text)."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    figures = [F.min("keep_id").alias("keep_id"), F.sum("n").alias("n")]
    salted = rows.groupBy("digest", salt.alias("salt"), "text").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    # Dealt by digest alone, so that counting the texts of a digest needs no further shuffle.
    return salted.repartition("digest").groupBy("digest", "text").agg(*figures)


def _grouped(rows: DataFrame, groups: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` with the keep_id and size of their digest's group; groups of one row are not looked up."""
    several = groups.where("n > 1").select("digest", "keep_id", "n")
    share = F.lit(n_rows) <= F.col("n") * HOT_SHARE
    hot, other = several.where(share), several.where(~share)
    found = rows.join(F.broadcast(hot), "digest")
    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(other, "digest", "left")
    return found.unionByName(rest)


def exact_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest of the normalised text."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(F.col(text)).alias("text"))
    texts = texts.select("doc_id", digest(F.col("text")).alias("digest"), "text")
    # The number tells repeated rows apart; it is settled when the rows are written.
    marks = texts.select("doc_id", "digest", F.monotonically_increasing_id().alias("row"))
    marks = stored(marks, "document-digests")
    n_rows = marks.count()

    per_digest = combine(texts, salts).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n_texts"), F.min("keep_id").alias("keep_id"), F.sum("n").alias("n")
    )
    groups = stored(per_digest, "digest-groups")
    whole = marks.join(groups.where("n_texts > 1").select("digest"), "digest", "left_anti")
    results = [_grouped(whole, groups.where("n_texts = 1"), n_rows).withColumn("variant", F.lit(None).cast("string"))]
    clashing = groups.where("n_texts > 1").select("digest")
    if not clashing.isEmpty():
        whole_texts = texts.join(clashing, "digest", "left_semi")
        by_text = combine(whole_texts, salts).select("digest", "text", "keep_id", "n")
        again = whole_texts.withColumn("row", -1 - F.monotonically_increasing_id()).join(by_text, ["digest", "text"])
        results.append(again.select("digest", "doc_id", "row", "keep_id", "n", F.col("text").alias("variant")))
    found = stored(reduce(DataFrame.unionByName, results), "grouped-documents")
    # Of rows with the smallest doc_id of their group, the first one stays.
    first = found.where("n > 1 and doc_id <=> keep_id").groupBy("digest", "variant").agg(F.min("row").alias("first"))
    first = first.select(F.col("first").alias("row"), F.lit(True).alias("_first"))
    return found.join(first, "row", "left").select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | F.coalesce("_first", F.lit(False))).alias("kept"),
        "digest",
    )


def op13_exact_dedup(spark, folder: str) -> DataFrame:
    found = exact_dedup(spark.read.parquet(f"{folder}/documents.parquet"))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", sha)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (same ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""
