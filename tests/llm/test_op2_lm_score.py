from __future__ import annotations

import math
from collections import Counter

import pytest

from billmill.llm.op2_lm_score import SMOOTHING, lm_score, op2_lm_score


def grams(text):
    data = b"\0\0\0\0" + (text or "").encode()
    return [data[i - 4 : i + 1] for i in range(4, len(data))]


def loss(counts):
    contexts, single = Counter(), Counter()
    for gram, n in counts.items():
        contexts[gram[:4]] += n
        single[gram[4]] += n
    whole = sum(single.values())

    def of(gram):
        p = (single[gram[4]] + 1) / (whole + 256)
        return -math.log((counts[gram] + SMOOTHING * p) / (contexts[gram[:4]] + SMOOTHING))

    return of


@pytest.mark.parametrize("bucket_bytes", [2_000, 10_000_000])
def test_losses_equal_a_direct_count(spark, boundary, bucket_bytes):
    targets = {3, 4, 6}
    rows = [(r.doc_id, r.text) for r in boundary.collect()]
    everything, good = Counter(), Counter()
    for i, text in rows:
        everything.update(grams(text))
        if i in targets:
            good.update(grams(text))
    of = loss(good), loss(everything)
    expected = sorted(
        (str(i), len(g), *[round(sum(map(f, g)) / max(len(g), 1), 6) + 0.0 for f in of])
        for i, g in ((i, grams(text)) for i, text in rows)
    )
    labels = spark.createDataFrame([(i,) for i in targets] + [(None,)], "doc_id long")
    found = lm_score(boundary, labels, bucket_bytes=bucket_bytes).collect()
    assert expected == sorted(
        (str(r.doc_id), r.n_bytes, round(r.target_loss, 6) + 0.0, round(r.background_loss, 6) + 0.0) for r in found
    )
    assert all(abs(r.background_loss - r.target_loss - r.score) < 1e-9 for r in found)


def test_good_documents_score_higher(spark, small):
    score = {r.doc_id: r.score for r in op2_lm_score(spark, small).collect()}
    labels = spark.read.parquet(f"{small}/labels.parquet").collect()
    mean = [0.0, 0.0]
    for quality in (0, 1):
        of = [score[r.doc_id] for r in labels if r.quality == quality]
        mean[quality] = sum(of) / len(of)
    assert mean[1] > mean[0]


def test_empty_tables(spark, boundary):
    none = spark.createDataFrame([], "doc_id long")
    assert lm_score(boundary.limit(0), none).collect() == []
    assert lm_score(boundary, none).count() == boundary.count()


def test_no_bucket_grows_with_a_doc_id_or_a_text(spark):
    from billmill.llm.op2_lm_score import bucketed

    rows = [(None, "the same text of some length")] * 3000 + [(7, f"text {i} of one id") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    targets = spark.createDataFrame([(7,)], "doc_id long")
    texts = bucketed(df, targets, "doc_id", "text", 5_000)
    sizes = [r["count"] for r in texts.groupBy("bucket").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 3 * sum(sizes) / len(sizes)
    assert texts.where("good").count() == 3000 and texts.where("doc_id = 7 and not good").count() == 0
