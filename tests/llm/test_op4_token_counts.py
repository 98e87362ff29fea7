from __future__ import annotations

import random
import re

from billmill.llm.op4_token_counts import _model, VOCABULARY, op4_token_counts, token_counts


def brute(text):
    """Forward computation of every pre-token by itself."""
    model = _model(VOCABULARY)
    cost_of = dict(zip(model.entries, model.costs.tolist()))
    longest = max(map(len, model.entries))
    white = rb"[\x20\x09-\x0D]"
    n = tokens = cost = 0
    for word in re.findall(rb" ?[^\x20\x09-\x0D]+|%b+?(?= [^\x20\x09-\x0D])|%b+" % (white, white), (text or "").encode()):
        best = [(0, 0)]
        for i in range(1, len(word) + 1):
            starts = (j for j in range(max(0, i - longest), i) if word[j:i] in cost_of)
            best.append(min((best[j][0] + cost_of[word[j:i]], best[j][1] + 1) for j in starts))
        n, tokens, cost = n + 1, tokens + best[-1][1], cost + best[-1][0]
    return n, tokens, cost


def test_random_texts(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab the\n\t  é日.") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["x" * 700 + " y", "a  b", " \n x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_pretokens, r.n_tokens, r.cost) for r in token_counts(df).collect()}
    assert found == {i: brute(t) for i, t in enumerate(texts)}


def test_whole_table_and_boundary(spark, small, boundary):
    rows = spark.read.parquet(f"{small}/documents.parquet").limit(40).collect()
    found = {r.doc_id: (r.n_pretokens, r.n_tokens, r.cost) for r in op4_token_counts(spark, small).collect()}
    assert all(found[r.doc_id] == brute(r.text) for r in rows)
    expected = sorted((str(r.doc_id), *brute(r.text)) for r in boundary.collect())
    assert sorted((str(r[0]), *r[1:]) for r in token_counts(boundary).collect()) == expected
    assert token_counts(boundary.limit(0)).collect() == []
