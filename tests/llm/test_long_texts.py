"""Texts above the size of a slice, and tables without rows, for the operators whose other tests hold none."""

from __future__ import annotations

import math

import pytest

from billmill.llm.op1_jaccard_join import jaccard_join
from billmill.llm.op2_lm_score import lm_score
from billmill.llm.op4_token_counts import op4_token_counts
from billmill.llm.op5_decontaminate import decontaminate
from billmill.llm.op7_bpe import digests
from billmill.llm.words import SLICE_BYTES

WORDS = 300_000


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"w{i}" for i in range(WORDS))
    assert len(long) > 2 * SLICE_BYTES
    rows = [(1, long), (2, long + " end"), (3, "short text of a few words only"), (4, None), (5, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2).cache()


def test_jaccard(docs):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(docs).collect()}
    assert found == {1: (WORDS - 4, 1), 2: (WORDS - 3, 1), 3: (3, 3), 4: (0, 4), 5: (0, 5)}


def test_language_model(docs):
    targets = docs.where("doc_id in (1, 3)").select("doc_id")
    found = {r.doc_id: r for r in lm_score(docs, targets).collect()}
    sizes = {r.doc_id: len(r.text or "") for r in docs.collect()}
    assert {i: r.n_bytes for i, r in found.items()} == sizes
    assert all(math.isfinite(r.score) for r in found.values()) and found[4].score == found[5].score == 0
    assert abs(found[1].target_loss - found[2].target_loss) < 1e-3
    assert lm_score(docs.limit(0), targets).collect() == []


def test_benchmark(spark, docs):
    item = " ".join(f"w{i}" for i in range(WORDS - 20, WORDS))
    benchmark = spark.createDataFrame([("a", item), ("b", "no such words stand anywhere at all in these texts, not even one of them")], "item_id string, text string")
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate(docs, benchmark).collect()}
    assert found == {1: (WORDS, 20, 1), 2: (WORDS + 1, 20, 1), 3: (7, 0, 0), 4: (0, 0, 0), 5: (0, 0, 0)}
    assert decontaminate(docs.limit(0), benchmark).collect() == []


def test_bpe(docs):
    import hashlib

    found = {r.doc_id: r for r in digests(docs).collect()}
    for r in docs.collect():
        assert found[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert digests(docs.limit(0)).collect() == []


def test_token_counts(docs, folder):
    found = {r.doc_id: r.n_tokens for r in op4_token_counts(docs.sparkSession, folder(documents=docs)).collect()}
    assert found[4] == found[5] == 0 and found[1] >= WORDS and 0 < found[2] - found[1] <= 2
