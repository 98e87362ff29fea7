from __future__ import annotations

import hashlib
import random

import pyarrow as pa

from billmill.llm import op3_suffix_dedup as op3


def brute(rows, length=100):
    """By definition: every window in order of doc_id and start."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (key, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return sorted(out.values())


def planted(seed):
    rng = random.Random(seed)

    def noise(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    passages = [noise("abcde fgh", rng.choice([90, 100, 101, 150, 400])) for _ in range(12)]
    passages += ["ab" * 200, "x" * 350, "é" * 80, "abc " * 100]  # periods shorter than a window
    rows = [(0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 205)]
    for i in range(5, 200):
        parts = []
        for _ in range(rng.randint(1, 6)):
            kind = rng.randrange(3)
            passage = rng.choice(passages)
            parts.append([passage, passage[rng.randint(0, 60) :], noise("qrstuv", rng.randint(0, 120))][kind])
        rows.append((i * 3, "".join(parts)))
    return rows


def result(spark, path):
    return sorted(tuple(r) for r in op3.op3_suffix_dedup(spark, path).collect())


def test_planted_passages(spark, folder):
    rows = planted(3)
    path = folder(documents=spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert result(spark, path) == brute(rows)


def test_pieces_of_a_very_long_text_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(op3, "SLICE_BYTES", 300)
    data, at = op3.text_bytes(pa.array(["".join(t or "" for _, t in planted(4)[:60])]))
    windows = []
    for piece, cut, place in op3._pieces(data, at, 100):
        _, _, _, first, last, _ = op3.sample(piece, cut, 100, 32)
        windows += [i + place for f, l in zip(first.tolist(), last.tolist()) for i in range(f, l + 1)]
    assert len(data) > 4 * 300
    assert windows == list(range(len(data) - 99))


def test_rows_without_id_ties_and_empty_table(spark, folder, boundary):
    rows = [(1, "p" * 150, "a"), (1, "p" * 150, "b"), (None, "p" * 150, "c"), (2, "p" * 120, "d"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tie string")
    found = {(r.doc_id, r.n_removed, r.n_spans) for r in op3.op3_suffix_dedup(spark, folder(documents=df)).collect()}
    assert found == {(1, 149, 1), (None, 0, 0), (2, 120, 1), (3, 0, 0)}
    texts, cut = op3.suffix_dedup(boundary)
    assert texts.count() == boundary.count()
    assert {(r.doc_id, s.end) for r in cut.collect() for s in r.spans} == {(7, 2999 + 1), (8, 20000)}
    assert op3.suffix_dedup(boundary.limit(0))[1].collect() == []
