from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from oracle import same_rows

from billmill.llm import op11_collocations as op11
from billmill.llm.op11_collocations import SQL, Tokens, chunks, collocations, op11_collocations


def brute(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) of rows (text, lang)."""
    f, out = defaultdict(Counter), []
    for text, lang in rows:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            f[lang or "und"].update(" ".join(words[i : i + m]) for m in (1, 2, 3) for i in range(len(words) - m + 1))
    for lang, count in f.items():
        n = sum(c for phrase, c in count.items() if " " not in phrase)
        phrases = {p: a for p, a in count.items() if " " in p and a >= least}
        kept = []
        for phrase, a in phrases.items():
            words = phrase.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = count[" ".join(words[:k])], count[" ".join(words[k:])]
                cuts.append((10**6 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            longer = [b for p, b in phrases.items() if len(p.split(" ")) > len(words) and f" {phrase} " in f" {p} "]
            if not any(100 * b >= 50 * a for b in longer):
                kept.append((-score, -a, phrase.encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n long, phrase string")


def found(df, **options):
    return sorted(tuple(r) for r in collocations(df, **options).collect())


def random_rows(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "of", "Bill", "rights", "new", "york", "city", "é", "x y", "日本", "a-b", "\x01", "z"]
    weights = [8, 6, 2, 2, 3, 3, 2, 1, 1, 1, 1, 1, 1]

    def text():
        out = []
        for _ in range(rng.randrange(25)):
            out.append(rng.choice(["bill of rights", "New York city", "new york"]) if rng.random() < 0.2 else rng.choices(words, weights)[0])
        return "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  "]) for w in out)

    return [(text(), rng.choice(["en", "en", "de", None])) for _ in range(n)]


@pytest.mark.parametrize("top", [1, 3, 10, 2000])
def test_random_tables(spark, top):
    rows = random_rows(top)
    assert found(table(spark, rows), min_count=3, top=top) == brute(rows, 3, top)


def test_many_false_bits_change_nothing(spark, monkeypatch):
    rows = random_rows(7)
    monkeypatch.setattr(op11, "_MOST_BITS", 64)
    assert found(table(spark, rows), min_count=2, top=5) == brute(rows, 2, 5)


def test_boundary_rows(spark, boundary):
    rows = [(r.text, r.source) for r in boundary.collect()]
    df = boundary.drop("lang").withColumnRenamed("source", "lang")
    assert found(df) == brute(rows, 10, 2000)
    assert found(df.limit(0)) == []


def test_one_language_goes_on_alone(spark):
    """A language whose pairs are mostly superseded needs a lower floor than the other one."""
    parts = [f"w{i} x{i} y{i}" for i in range(30)]
    rows = [(f"{p}. ", "aa") for p in parts for _ in range(4)] + [(f"k{i} m{i}. other k{i}", "bb") for i in range(30) for _ in range(4)]
    assert found(table(spark, rows), min_count=2, top=12) == brute(rows, 2, 12)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    texts = [("one two, three four five. " * 40 + "x y " * 30).encode(), b"", b"six seven"]

    def counts():
        n = Counter()
        for part in chunks(texts):
            tokens = Tokens(part)
            first, second = tokens.pairs()
            n.update((tokens.words[i].as_py(), tokens.words[j].as_py()) for i, j in zip(first.tolist(), second.tolist()))
        return n

    whole = counts()
    for size in (8, 50, 400):
        monkeypatch.setattr(op11, "_CHUNK", size)
        assert counts() == whole


def test_sql_twin_with_ties(spark, folder):
    rows = [("a b. c d. e f g", "en"), ("a b c", None), (None, "en"), ("", "fr")] * 12
    df = table(spark, rows).selectExpr("1L as doc_id", "text", "lang", "lang as source")
    same_rows(spark, op11_collocations, SQL, folder(documents=df))
