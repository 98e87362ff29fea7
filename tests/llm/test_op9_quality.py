from __future__ import annotations

import re

from billmill.llm.op9_quality import REPEATED_WINDOWS, op9_quality_rules, quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    places = {}
    for i in range(n - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {p for at in places.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = n < 20 or 100 * len(hit) > 30 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


def figures(rows):
    return sorted(
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows
    )


def test_base_figures(spark, small, boundary):
    for df, found in (
        (spark.read.parquet(f"{small}/documents.parquet"), op9_quality_rules(spark, small)),
        (boundary, quality(boundary)),
    ):
        assert figures(found.collect()) == sorted((str(r.doc_id), *brute(r.text)) for r in df.collect())
    assert quality(boundary.limit(0)).collect() == []


def test_verdict(spark):
    clean = " ".join(f"w{i}" for i in range(200))
    fives = " ".join(f"a b c d e{' '}x{i}" for i in range(60))  # repeated 5-grams only
    lines = "\n".join([f"line {i} with some words" for i in range(20)] + ["the same line of some length"] * 12)
    once_again = f"{clean}\nOne line.\nOne line."
    marked = " ".join(f"w{i}&&&" for i in range(40))
    rows = [(1, clean), (2, fives), (3, lines), (4, None), (5, once_again), (6, marked)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: (r.base_failed, r.kept) for r in quality(df).collect()}
    assert kept == {i: (i in (3, 4), i in (1, 5)) for i in range(1, 7)}


def test_every_window_length_can_decide(spark):
    """A phrase of n words said a few times in a long text: longer phrases are let through less often."""
    filler = iter(range(10**6))

    def text(n, times, words):
        phrase = " ".join(f"p{i:05d}" for i in range(n))
        rest = [f"w{next(filler):06d}" for _ in range(words - n * times)]
        step = len(rest) // times
        return " ".join(" ".join(rest[i * step : (i + 1) * step]) + " " + phrase for i in range(times))

    rows = [(n, text(n, 40, int(40 * n / (limit - 0.02)))) for n, limit in REPEATED_WINDOWS.items() if n >= 8]
    rows += [(100 + n, text(n, 40, int(40 * n / (limit - 0.02)) + 4000)) for n, limit in REPEATED_WINDOWS.items()]
    rows += [(1000, text(12, 2, 100))]  # one sentence twice
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality(df).collect()}
    assert kept[1000] and all(kept[100 + n] for n in REPEATED_WINDOWS)
    for n in (8, 9, 10):
        others = {m: 1.0 for m in REPEATED_WINDOWS if m != n} | {n: REPEATED_WINDOWS[n] - 0.04}
        decided = {r.doc_id: r.kept for r in quality(df, limits=others).collect()}
        assert not decided[n]


def test_a_text_longer_than_a_slice(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    df = spark.createDataFrame([(1, long), (2, long + " " + long), (3, None)], "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.kept, r.base_failed) for r in quality(df).collect()}
    assert found == {1: (300_000, True, False), 2: (600_000, False, True), 3: (0, False, True)}
