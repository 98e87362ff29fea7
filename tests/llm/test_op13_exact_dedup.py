from __future__ import annotations

import hashlib
import re

from oracle import same_rows
from pyspark.sql import functions as F

from billmill.llm.op13_exact_dedup import SQL, exact_dedup, op13_exact_dedup


def brute(rows):
    """(doc_id, keep_id, group_size, kept, digest), sorted; of equal rows one stays."""
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    out = []
    for text, docs in groups.items():
        docs.sort(key=lambda d: (d is None, d or 0))
        sha = hashlib.sha256(text.encode()).digest()
        out += [(d, docs[0], len(docs), i == 0, sha) for i, d in enumerate(docs)]
    return sorted(out, key=str)


def found(df, **options):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in exact_dedup(df, **options).collect()), key=str)


def test_boundary_rows(spark, boundary):
    rows = [(r.doc_id, r.text) for r in boundary.collect()]
    assert found(boundary) == brute(rows)
    assert found(boundary.limit(0)) == []


def test_repeated_rows_keep_one(spark, folder):
    long = "a  b\n" * 400_000
    rows = [(7, "x  y"), (7, "x y"), (3, "x\ty"), (3, "x y"), (None, "x y"), (None, None), (None, ""), (1, " "), (2, long), (9, long + "\t")]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n long, digest string")
    assert found(df) == brute(rows)
    same_rows(spark, op13_exact_dedup, SQL, folder(documents=df))


def test_texts_decide_not_digests(spark):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain = [row[:4] for row in found(df)]
    assert [row[:4] for row in found(df, digest=lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1)))] == plain
    assert [row[:4] for row in found(df, salts=1, digest=lambda t: F.unhex(F.lit("00")))] == plain


def test_hot_text_is_one_row_per_task(spark):
    df = spark.range(0, 30_000, numPartitions=8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.col("id").cast("string")).alias("text")
    )
    result = exact_dedup(df)
    assert result.where("kept").count() == 20_001
    assert result.where("group_size = 10000 and keep_id = 0").count() == 10_000
