"""Quality rules: how much of a text repeats itself.

Word windows of several lengths are hashed for a whole slice of texts at once. A document is rejected if
too many of its characters lie inside repeated windows or repeated lines, or if it has a symbol for every
tenth word. Longer windows repeat less by chance, so their limits are lower; some characters are free, so that one
sentence said twice passes. Each row is judged on its own:
no shuffle, equal rows get equal results, other columns are ignored. A null text has no words; it and
every text of fewer than 20 words fail the base rule. An empty table gives an empty result; a very long text is a
slice of its own and judged whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmill.llm.words import WHITE, Words, by_text, field, mix, slices, text_bytes, windows

# Largest share of a text's word characters inside windows of n words that occur twice or more, beyond the free ones.
REPEATED_WINDOWS = {4: 0.20, 5: 0.18, 6: 0.17, 7: 0.15, 8: 0.13, 9: 0.12, 10: 0.10}
FREE_CHARS = 100
# Largest share of characters in lines that repeat an earlier line, and of symbols per word.
REPEATED_LINE_CHARS = 0.20
SYMBOLS_PER_WORD = 0.10
BASE_WINDOW, BASE_WORDS, BASE_PERCENT = 8, 20, 30

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, dup_line_chars long, repeated_share double, base_failed boolean, kept boolean"
)


def covered(words: Words, hashes: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a window of ``size`` words that its text holds twice or more."""
    out = np.zeros(len(words), bool)
    keys = windows(hashes, size)
    starts = np.flatnonzero(words.text[: len(keys)] == words.text[size - 1 :]) if len(keys) else []
    if not len(starts):
        return out
    keys = mix(keys[starts] ^ mix(words.text[starts].astype(np.uint64)))  # equal only within a text
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    repeated = np.zeros(len(starts), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = starts[repeated]
    edge[at] += 1
    edge[at + size] -= 1
    return np.cumsum(edge[:-1]) > 0


def repeated_lines(text: str) -> tuple[int, int, int]:
    """Lines with a word, how many of them equal an earlier line, and the characters of the latter."""
    seen: set[str] = set()
    lines = again = chars = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            lines += 1
            if line in seen:
                again += 1
                chars += len(line)
            else:
                seen.add(line)
    return lines, again, chars


def measure(batches: Iterator[pa.RecordBatch], limits: Mapping[int, float]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts = field(batch, "text")
        data, at = text_bytes(texts)
        words = Words(data, at, WHITE)
        hashes, chars = words.hashes(), words.code_points()
        n_words, word_chars = words.counts, by_text(words.firsts, chars)
        symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
        n_symbols = symbols[at[1:]] - symbols[at[:-1]]
        lines = np.array([repeated_lines(t or "") for t in texts.to_pylist()], np.int64).reshape(-1, 3)
        inside = {size: covered(words, hashes, size) for size in {*limits, BASE_WINDOW}}
        repeat_words = by_text(words.firsts, inside[BASE_WINDOW])
        worst = np.zeros(len(n_words))
        over = np.zeros(len(n_words), bool)
        for size, limit in limits.items():
            repeated = by_text(words.firsts, chars * inside[size])
            over |= repeated > limit * word_chars + FREE_CHARS
            worst = np.maximum(worst, repeated / np.maximum(word_chars, 1))
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        text_chars = heads[at[1:]] - heads[at[:-1]]
        over |= lines[:, 2] > REPEATED_LINE_CHARS * np.maximum(text_chars, 1)
        over |= n_symbols > SYMBOLS_PER_WORD * n_words
        failed = (n_words < BASE_WORDS) | (100 * repeat_words > BASE_PERCENT * n_words)
        yield pa.RecordBatch.from_arrays(
            [
                field(batch, "doc_id"),
                *[pa.array(x.astype(np.int64)) for x in (n_words, word_chars, n_symbols, lines[:, 1], repeat_words)],
                pa.array(lines[:, 0]),
                pa.array(lines[:, 2]),
                pa.array(worst),
                pa.array(failed),
                pa.array(~failed & ~over),
            ],
            names=[part.split()[0] for part in SCHEMA.split(", ")],
        )


def quality(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: Mapping[int, float] = REPEATED_WINDOWS
) -> DataFrame:
    """One row per row of ``docs`` with its repetition figures and the verdict ``kept``."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(lambda batches: measure(batches, limits), SCHEMA)


def op9_quality_rules(spark, folder: str) -> DataFrame:
    return quality(spark.read.parquet(f"{folder}/documents.parquet"))


_LIMITS = ", ".join(f"({n}, {limit})" for n, limit in REPEATED_WINDOWS.items())
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
l(n, most) AS (VALUES {_LIMITS}),
g AS (SELECT r, n, i, array_to_string(list_slice(w, i + 1, i + n), ' ') AS s
      FROM (SELECT r, n, w, unnest(range(len(w) - n + 1)) AS i FROM w, l WHERE len(w) >= n)),
twice AS (SELECT r, n, i FROM (SELECT r, n, i, count(*) OVER (PARTITION BY r, n, s) AS c FROM g) WHERE c > 1),
inside AS (SELECT r, n, count(*) AS words, sum(length(w[p + 1])) AS chars
           FROM (SELECT DISTINCT r, n, unnest(range(i, i + n)) AS p FROM twice) JOIN w USING (r) GROUP BY r, n),
line AS (SELECT r, s, count(*) AS c FROM (SELECT r, unnest(string_split(t, chr(10))) AS s FROM d)
         WHERE regexp_matches(s, '[^\x20\x09-\x0D]') GROUP BY r, s),
lines AS (SELECT r, sum(c) AS n_lines, sum(c - 1) AS again, sum((c - 1) * length(s)) AS chars FROM line GROUP BY r),
total AS (SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, greatest(length(t), 1) AS chars FROM w),
share AS (SELECT r, max(inside.chars / greatest(word_chars, 1)) AS worst,
            bool_or(inside.chars > most::DOUBLE * word_chars + {FREE_CHARS}) AS over,
            max(words) FILTER (WHERE n = {BASE_WINDOW}) AS repeat_words
          FROM inside JOIN l USING (n) JOIN total USING (r) GROUP BY r),
judged AS (SELECT total.*, coalesce(again, 0) AS again, coalesce(n_lines, 0) AS n_lines, coalesce(lines.chars, 0) AS again_chars,
             coalesce(repeat_words, 0) AS repeat_words, coalesce(worst, 0) AS worst, coalesce(over, FALSE) AS over
           FROM total LEFT JOIN lines USING (r) LEFT JOIN share USING (r)),
based AS (SELECT *, n_words < {BASE_WORDS} OR 100 * repeat_words > {BASE_PERCENT} * n_words AS failed FROM judged)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(again AS BIGINT) AS n_dup_lines, CAST(repeat_words AS BIGINT) AS n_repeat_words,
  CAST(n_lines AS BIGINT) AS n_lines, CAST(again_chars AS BIGINT) AS dup_line_chars, CAST(worst AS DOUBLE) AS repeated_share,
  failed AS base_failed, NOT failed AND NOT over
    AND NOT again_chars > {REPEATED_LINE_CHARS}::DOUBLE * chars
    AND NOT n_symbols > {SYMBOLS_PER_WORD}::DOUBLE * n_words AS kept
FROM based
"""
