"""Source divergence audit: how far the word use of each source lies from its language and from other sources.

1. Tokenizer: one ``bytes.translate`` lowers A-Z and blanks everything that is no term byte, ``bytes.split`` gives
   the terms, a ``Counter`` per document their frequencies. A document's Counter is one count of documents and one
   frequency per term, so both are summed together, per slice of texts in Arrow and then in Spark.
2. Kept terms: those in enough documents of their language. Only these go on; counts stay sparse (no zeros).
3. Smoothed shares p in whole billionths, exact in decimals, of every source and of the whole language.
4. ``term``: the kept terms that a source uses more than its language, first ranks only.
5. ``pair``: the summed difference of two sources over all kept terms. Sources are dealt into blocks and terms into
   parts; a task holds one part of two blocks as small matrices. Terms that neither source of a pair has differ by
   the same amount each and are added as one product, so zeros are never written out.

Null text, lang and source are empty strings. A source without terms still has rows (its shares are all equal), a
language without kept terms has pairs of value 0. Repeated rows are documents of their own; doc_id and all other
columns are ignored. An empty table gives an empty result. A very long text is split in pieces of bounded size; its
Counter holds its distinct terms only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billmill.llm.steps import stored
from billmill.llm.words import field

MIN_DOCUMENTS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
SOURCE_BLOCK, TERM_PART = 64, 4096  # about so many sources and terms meet in one matrix; they only deal the work
_PIECE = 1 << 22
_PENDING = 1 << 19

# Letters and all bytes of other scripts are term bytes; everything else becomes a blank.
TRANSLATE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """The frequencies of a text's terms."""
    counts: Counter = Counter()
    start = 0
    while len(text) - start > _PIECE:
        blanked = text[start : start + _PIECE].translate(TRANSLATE)
        end = blanked.rfind(b" ")
        if end <= 0:  # a term as long as a piece: take the rest at once
            break
        counts.update(blanked[:end].split())
        start += end
    counts.update(text[start:].translate(TRANSLATE).split())
    return counts


class _Slice:
    """Term frequencies of some documents, to be summed per group and term."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.group: list[int] = []
        self.term: list[bytes] = []
        self.n: list[int] = []

    def add(self, group: tuple[str, str], counts: Counter) -> None:
        # The empty term marks the group as occurring, with or without terms.
        self.group += [self.groups.setdefault(group, len(self.groups))] * (len(counts) + 1)
        self.term += [b"", *counts]
        self.n += [0, *counts.values()]

    def summed(self) -> list[pa.RecordBatch]:
        table = pa.table({"g": pa.array(self.group, pa.int32()), "term": pa.array(self.term, pa.binary()), "n": pa.array(self.n, pa.int64())})
        table = table.group_by(["g", "term"]).aggregate([("n", "sum"), ("n", "count")])
        langs, sources = (pa.array(names, pa.string()) for names in zip(*self.groups))
        columns = {
            "lang": langs.take(table["g"].combine_chunks()),
            "source": sources.take(table["g"].combine_chunks()),
            "term": table["term"].combine_chunks().cast(pa.string()),
            "n": table["n_sum"].combine_chunks(),
            "docs": table["n_count"].combine_chunks(),
        }
        return pa.table(columns).to_batches(max_chunksize=1 << 16)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n, docs: summed over as many documents as a bounded list of terms holds."""
    held = _Slice()
    for batch in batches:
        texts = field(batch, "text").cast(pa.binary())
        for lang, source, text in zip(field(batch, "lang").to_pylist(), field(batch, "source").to_pylist(), texts):
            held.add((lang, source), term_counts(text.as_py()))
            if len(held.term) >= _PENDING:
                yield from held.summed()
                held = _Slice()
    if held.term:
        yield from held.summed()


def term_table(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n, docs over the whole table; the row with the empty term counts the documents."""

    def whole(name: str, new: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(new)

    texts = docs.select(whole(lang, "lang"), whole(source, "source"), whole(text, "text"))
    rows = texts.mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str) -> Column:
    """1 + floor(10**9 * (count + 5) / (total + 5 * n_terms)), exact for counts up to 10**19; NULL without kept terms."""
    above = f"(CAST({count} AS DECIMAL(20,0)) + {SMOOTHING}) * CAST({UNIT} AS DECIMAL(10,0))"
    below = f"CAST({total} AS DECIMAL(20,0)) + CAST(n_terms AS DECIMAL(20,0)) * {SMOOTHING}"
    return F.expr(f"1 + ({above}) div nullif({below}, 0)")


def kept_counts(table: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """lang, source, term, n, lang_n: the kept terms, those in enough documents of their language."""
    per_term = table.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = per_term.where(F.col("docs") >= min_documents).drop("docs")
    return table.drop("docs").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")


def group_totals(table: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per occurring group: ``total`` (its kept occurrences), ``lang_total``, ``n_terms`` (kept terms of the language), ``p0`` (the
    share of a term it lacks) and ``groups`` of the language."""
    groups = table.where("term = ''").select("lang", "source")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("n"))
    by_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("lang_total"))
    size = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups"))
    totals = groups.join(sums, ["lang", "source"], "left").join(by_lang, "lang", "left").join(size, "lang")
    none = F.lit(0).cast("long")
    totals = totals.select("lang", "source", "groups", *[F.coalesce(c, none).alias(c) for c in ("total", "n_terms", "lang_total")])
    return totals.withColumn("p0", F.coalesce(_share("0", "total"), none))


def top_terms(shares: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item, value, rank of the terms that a source uses more than its language."""
    rows = shares.withColumn("q", _share("lang_n", "lang_total")).where("p > q")
    rows = rows.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _differences(key: tuple, rows: pa.Table) -> pa.Table:
    """Summed differences of the sources of two blocks over one part of the terms, and how many terms this covers."""
    lang, low, high, _ = (k.as_py() for k in key)
    rows = rows.combine_chunks()
    sources = rows["source"].combine_chunks().dictionary_encode()
    terms = rows["term"].combine_chunks().dictionary_encode()
    who, what = sources.indices.to_numpy(), terms.indices.to_numpy()
    names = sources.dictionary.to_pylist()
    shares = np.zeros((len(names), len(terms.dictionary)), np.int64)
    # Every source has a row for the empty term, with its share of terms that it lacks.
    shares[who] = rows["p0"].to_numpy()[:, None]
    block = np.zeros(len(names), np.int64)
    block[who] = rows["block"].to_numpy()
    none = terms.dictionary.index("").as_py()
    shares[who, what] = rows["p"].to_numpy()
    shares[:, none] = 0
    out = {"source": [], "other": [], "value": []}
    for i, name in enumerate(names):
        others = np.flatnonzero((block != block[i]) if low != high else (np.arange(len(names)) != i))
        sums = np.abs(shares[others] - shares[i]).sum(axis=1)
        out["source"] += [name] * len(others)
        out["other"] += [names[j] for j in others.tolist()]
        out["value"] += sums.tolist()
    n = len(out["source"])
    return pa.table(
        {
            "lang": pa.array([lang] * n, pa.string()),
            "source": pa.array(out["source"], pa.string()),
            "other": pa.array(out["other"], pa.string()),
            "value": pa.array(out["value"], pa.int64()),
            "covered": pa.array([len(terms.dictionary) - 1] * n, pa.int64()),
        }
    )


def pair_differences(shares: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item (another source), value: both directions of every pair of a language."""
    blocks = totals.withColumns(
        {
            "blocks": F.ceil(F.col("groups") / SOURCE_BLOCK).cast("int"),
            "parts": F.ceil(F.col("n_terms") / TERM_PART).cast("int"),
        }
    ).withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    blocks = blocks.select("lang", "source", "p0", "block", "blocks", "parts")
    held = shares.select("lang", "source", "term", "p").join(blocks, ["lang", "source"])
    held = held.withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
    marks = blocks.where("parts > 0").select(
        "*", F.lit("").alias("term"), F.col("p0").alias("p"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    rows = held.unionByName(marks)
    # A block meets every block of its language, itself included, once.
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "lang", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "part", "block", "source", "term", "p", "p0"
    )
    schema = "lang string, source string, other string, value long, covered long"
    met = rows.groupBy("lang", "low", "high", "part").applyInArrow(_differences, schema)
    sums = met.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered"))
    ends = totals.select("lang", "source", "p0", "n_terms")
    # The result itself has a row for every two sources of a language, so this join is as large as the result.
    pairs = ends.join(ends.select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0")), "lang").where("source <> other")
    found = pairs.join(sums, ["lang", "source", "other"], "left")
    rest = F.expr("(n_terms - coalesce(covered, 0L)) * abs(p0 - other_p0)")
    return found.select("lang", "source", F.col("other").alias("item"), (F.coalesce("value", F.lit(0)) + rest).alias("value"))


def source_audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """lang, source, part, item, value, rank."""
    table = stored(term_table(docs, text, lang, source), "term-counts")
    kept = stored(kept_counts(table, min_documents), "kept-terms")
    totals = stored(group_totals(table, kept), "group-totals")
    shares = kept.join(totals.select("lang", "source", "total", "lang_total", "n_terms"), ["lang", "source"])
    shares = shares.withColumn("p", _share("n", "total"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_differences(shares, totals).withColumn("rank", F.row_number().over(order))

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionByName(part(top_terms(shares, top), "term"))


def op12_source_audit(spark, folder: str) -> DataFrame:
    return source_audit(spark.read.parquet(f"{folder}/documents.parquet"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY lang, term HAVING sum(docs) >= {MIN_DOCUMENTS}),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS total FROM c JOIN k USING (lang, term) GROUP BY lang, source),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + {SMOOTHING})) // (coalesce(s.total, 0) + {SMOOTHING} * l.v) AS p,
           1 + ({UNIT}::HUGEINT * (k.lang_n + {SMOOTHING})) // (l.lang_total + {SMOOTHING} * l.v) AS q
         FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang
         LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
         LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(far.value, 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
          UNION ALL SELECT lang, source, 'term', term, p - q FROM grid WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= {TOP_TERMS}
"""
