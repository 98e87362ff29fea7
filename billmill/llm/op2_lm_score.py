"""LM scoring by cross-entropy difference of two matched models.

Both models are byte 5-gram models over one vocabulary (the 256 byte values), with the same smoothing; the
target model is counted over the documents labelled as good, the background model over all documents. The
loss of a byte b after the four bytes c is -log((n(cb) + S * p(b)) / (n(c) + S)) with the model's unigram
p; before a text stand four zero bytes. A document's score is the mean over its bytes of background loss
minus target loss: higher means more like the target.

Counts come from every document. Texts are dealt into buckets of bounded size, row by row, so that neither a doc_id
nor a text that very many rows share makes a bucket larger; each bucket counts its
distinct n-grams before the shuffle, and gets back the two losses of just these n-grams for scoring. So no
task and no broadcast holds the whole model, which grows with the corpus.

A null or empty text has no bytes and score 0. Without target rows the target model is the uniform one.
Rows with one doc_id share their label; a doc_id with several labels is a target if any of them is good.
Rows without doc_id are never targets. Other columns are ignored. An empty table gives an empty result. A very long
text is a bucket's content by itself and is worked through in slices, never cut off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billmill.llm.steps import stored
from billmill.llm.words import field, slices, text_bytes

ORDER = 5
SMOOTHING = 8.0
BUCKET_BYTES = 12 << 20
_LAST = 0xFF


def grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each byte the number made of it and the four bytes before it in its text."""
    out = data.astype(np.int64)
    lengths = np.diff(at)
    place = np.arange(len(data)) - np.repeat(at[:-1], lengths)
    for back in range(1, ORDER):
        earlier = np.zeros(len(data), np.int64)
        earlier[back:] = data[: len(data) - back] if len(data) > back else 0
        out |= np.where(place >= back, earlier, 0) << (8 * back)
    return out


def bucketed(docs: DataFrame, targets: DataFrame, doc_id: str, text: str, bucket_bytes: int) -> DataFrame:
    """doc_id, text, good (counted for the target model) and bucket, stored: a row's bucket follows from its place in
    one run of the plan, so both readers must see the same rows."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # The targets grow with the corpus: this join shuffles at every size, and splits hot doc_ids.
    marked = texts.join(targets.withColumn("good", F.lit(True)).hint("merge"), "doc_id", "left")
    bucket = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)).cast("int")
    return stored(marked.select("doc_id", "text", F.coalesce("good", F.lit(False)).alias("good"), bucket.alias("bucket")), "bucketed-texts")


def bucket_counts(texts: DataFrame) -> DataFrame:
    """bucket, gram, n (background count) and t (target count): one row per n-gram and bucket."""

    def count(rows: pa.Table) -> pa.Table:
        keys, n, t = [], [], []
        bucket = rows["bucket"][0].as_py()
        for batch in slices(iter(rows.to_batches()), "text"):
            data, at = text_bytes(field(batch, "text"))
            good = field(batch, "good").to_numpy(zero_copy_only=False)
            found, which = np.unique(grams(data, at), return_inverse=True)
            keys.append(found)
            n.append(np.bincount(which, minlength=len(found)))
            t.append(np.bincount(which[np.repeat(good, np.diff(at))], minlength=len(found)))
        found, which = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
        sums = [np.bincount(which, np.concatenate([*x, np.zeros(0)]), len(found)).astype(np.int64) for x in (n, t)]
        return pa.table(
            {"bucket": pa.array(np.full(len(found), bucket, np.int32)), "gram": found, "n": sums[0], "t": sums[1]}
        )

    return texts.groupBy("bucket").applyInArrow(count, "bucket int, gram long, n long, t long")


def losses(counts: DataFrame) -> DataFrame:
    """gram, target and background loss, from the counts of all buckets."""
    totals = stored(counts.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "grams")
    context, byte = F.shiftright("gram", 8), F.col("gram").bitwiseAND(_LAST)
    after = totals.groupBy(context.alias("context")).agg(F.sum("n").alias("cn"), F.sum("t").alias("ct"))
    # 256 rows at most
    single = totals.groupBy(byte.alias("byte")).agg(F.sum("n").alias("un"), F.sum("t").alias("ut"))
    whole = single.agg(F.sum("un").alias("wn"), F.sum("ut").alias("wt"))
    shares = (("un", "wn", "pn"), ("ut", "wt", "pt"))
    single = single.select(
        "byte", *[((F.col(u) + 1) / (whole.select(w).scalar() + 256)).alias(p) for u, w, p in shares]
    )
    joined = (
        totals.withColumn("context", context)
        .withColumn("byte", byte)
        .join(after, "context")
        .join(F.broadcast(single), "byte")
    )

    def loss(n: str, c: str, p: str) -> Column:
        return -F.log((F.col(n) + SMOOTHING * F.col(p)) / (F.col(c) + SMOOTHING))

    return joined.select("gram", loss("t", "ct", "pt").alias("target"), loss("n", "cn", "pn").alias("background"))


def lm_score(
    docs: DataFrame,
    targets: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, target_loss, background_loss (means per byte), score.

    ``targets`` holds the doc_ids that the target model is counted over.
    """
    targets = targets.select(F.col(targets.columns[0]).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    texts = bucketed(docs, targets, doc_id, text, bucket_bytes)
    counts = stored(bucket_counts(texts), "bucket-counts")
    model = stored(losses(counts), "losses")
    needed = counts.select("bucket", "gram").join(model, "gram")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        gram = right["gram"].to_numpy()
        order = np.argsort(gram)
        gram = gram[order]
        both = np.stack([right["target"].to_numpy()[order], right["background"].to_numpy()[order]])
        out = []
        for batch in slices(iter(left.to_batches()), "text"):
            data, at = text_bytes(field(batch, "text"))
            where = np.searchsorted(gram, grams(data, at)) if len(gram) else np.zeros(0, np.int64)
            lengths = np.diff(at)
            means = []
            for side in both:
                sums = np.concatenate([[0.0], np.cumsum(side[where])])
                means.append((sums[at[1:]] - sums[at[:-1]]) / np.maximum(lengths, 1))
            out.append(
                pa.RecordBatch.from_arrays(
                    [field(batch, "doc_id"), pa.array(lengths), *map(pa.array, means), pa.array(means[1] - means[0])],
                    ["doc_id", "n_bytes", "target_loss", "background_loss", "score"],
                )
            )
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_bytes", pa.int64()), *[(c, pa.float64()) for c in ("target_loss", "background_loss", "score")]]
        )
        return pa.Table.from_batches(out, schema)

    return (
        texts.groupBy("bucket")
        .cogroup(needed.groupBy("bucket"))
        .applyInArrow(score, "doc_id long, n_bytes long, target_loss double, background_loss double, score double")
    )


def op2_lm_score(spark, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = labels.where("quality = 1").select("doc_id")
    return lm_score(spark.read.parquet(f"{folder}/documents.parquet"), good)
