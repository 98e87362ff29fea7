from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from oracle import same_rows

from billmill.llm import op12_source_audit as op12
from billmill.llm.op12_source_audit import SQL, op12_source_audit, source_audit, term_counts


def brute(rows, least):
    """(lang, source, part, item, value, rank) of rows (text, lang, source)."""
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
        n[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs:
        kept = sorted(t for t, d in docs[lang].items() if d >= least)
        groups = sorted(s for at, s in n if at == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(n[lang, s]) for s in groups}
        q = shares(sum((n[lang, s] for s in groups), Counter()))
        for s in groups:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, 50)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1]))[:most], 1):
                    out.append((lang, s, part, item.decode(), value, rank))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in source_audit(df, **options).collect())


def random_rows(seed, sources):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeé日" for b in ("x", "Yz", "ß", "q")]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randrange(30))), rng.choice(["en", "de", None]), rng.choice(sources)) for _ in range(120)]
    return rows + [(None, "en", "silent"), ("", None, None), ("12 3,4", "xx", "a"), ("one", "xx", "b")]


def table(spark, rows):
    return spark.createDataFrame([(t, lang, s, 1, "x") for t, lang, s in rows], "text string, lang string, source string, n long, term string")


def test_random_tables(spark, monkeypatch):
    rows = random_rows(1, ["a", "b", "c", None])
    assert found(table(spark, rows), min_documents=3) == brute(rows, 3)
    # Several blocks of sources and parts of terms.
    monkeypatch.setattr(op12, "SOURCE_BLOCK", 2)
    monkeypatch.setattr(op12, "TERM_PART", 3)
    rows = random_rows(2, [f"s{i}" for i in range(9)])
    assert found(table(spark, rows), min_documents=2) == brute(rows, 2)


def test_boundary_rows(spark, boundary):
    rows = [(r.text, None, r.source) for r in boundary.collect()]
    df = table(spark, rows)
    assert found(df, min_documents=1) == brute(rows, 1)
    assert found(df.limit(0)) == []


def test_sql_twin_with_few_terms(spark, folder):
    rows = [("the same words here", "en", f"s{i % 3}") for i in range(40)] + [("rare", "fr", "a"), (None, None, "b"), (None, None, None)]
    df = table(spark, rows).selectExpr("1L as doc_id", "text", "lang", "source")
    same_rows(spark, op12_source_audit, SQL, folder(documents=df))


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Alpha beta-Gamma é9" * 50 + " " + "z" * 300 + " x" * 40).encode()
    whole = term_counts(text)
    for size in (7, 64, 1000):
        monkeypatch.setattr(op12, "_PIECE", size)
        assert term_counts(text) == whole
