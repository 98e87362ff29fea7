"""Phrase collocations by best-first branch and bound.

1. Every word and every pair of neighbouring words is counted, per language, over the whole table: within a slice of
   texts in numpy, then in Spark before and after one shuffle. Pairs below ``min_count`` are no phrases, and no
   longer phrase holds one.
2. Every pair gets its score, and two bounds for the three-word phrases that begin or end with it: a phrase found a
   times scores at most a / f(first word) and at most a / f(last word), and a is at most the count of the pair.
3. Best first: each language gets a floor, the score of a pair far enough down its list. All phrases that reach the
   floor are found by counting only the three-word phrases whose two bounds reach it, and those that hold a pair of a
   score that reaches it (they may supersede the pair). What reaches the floor is then settled, ties included. A
   language with 2000 surviving phrases at its floor is finished; the others expand further with a lower floor, in
   the end 0, where every phrase is counted.

The frontier goes to the tasks as a bit table of bounded size. A pair whose bits are set by others is counted
needlessly, never the other way round; scores and survival are decided on whole phrases.

A null language is ``und``, a null or empty text has no words, a text shorter than two words has no phrases. Repeated
rows count as often as they stand there. Fewer than 2000 phrases are all returned, an empty table gives an empty
result. A very long text is cut between pieces (phrases do not span them); doc_id and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billmill.llm.steps import stored
from billmill.llm.words import field, mix, span_hashes, text_bytes

MIN_COUNT = 10
TOP = 2000
PERCENT = 50  # a phrase goes if a longer one that holds it has at least this share of its count
UNKNOWN_LANG = "und"
_SCORE_UNIT = 1_000_000
_CHUNK = 1 << 22
_MOST_BITS = 1 << 25  # per table: four tables, 16 MB, whatever the input
_BREAK = b"\xff"  # no byte of a UTF-8 text
# A-Z become lower case, tabs blanks, the ends of pieces a byte that no text holds.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b == 9 else 0xFF if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256)
)


def chunks(texts: list[bytes]) -> Iterator[bytes]:
    """The texts as pieces between breaks, cut into parts of bounded size where a piece ends."""
    held, size = [], 0
    for text in texts:
        text = text.translate(_TABLE)
        start = 0
        while len(text) - start > _CHUNK:
            end = text.rfind(_BREAK, start + 1, start + _CHUNK)
            end = end if end > 0 else text.find(_BREAK, start + _CHUNK)
            if end < 0:
                break
            yield text[start:end]
            start = end
        held.append(text[start:])
        size += len(text) - start
        if size >= _CHUNK:
            yield _BREAK.join(held)
            held, size = [], 0
    if held:
        yield _BREAK.join(held)


class Tokens:
    """The words of a part of some texts as numbers; -1 between pieces."""

    def __init__(self, part: bytes) -> None:
        words = part.replace(_BREAK, b" \xff ").split()
        coded = pa.array(words, pa.binary()).dictionary_encode()
        ids = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary
        at = self.words.index(pa.scalar(_BREAK, pa.binary())).as_py()
        self.ids = np.where(ids == at, -1, ids)
        self.at = at

    def counts(self) -> tuple[pa.Array, np.ndarray]:
        n = np.bincount(self.ids[self.ids >= 0], minlength=len(self.words))
        which = np.flatnonzero(n)
        return self.words.take(pa.array(which)), n[which]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of every two neighbours."""
        first, second = self.ids[:-1], self.ids[1:]
        inside = (first >= 0) & (second >= 0)
        return first[inside], second[inside]

    def triples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, second, third = self.ids[:-2], self.ids[1:-1], self.ids[2:]
        inside = (first >= 0) & (second >= 0) & (third >= 0)
        return first[inside], second[inside], third[inside]

    def hashes(self) -> np.ndarray:
        return word_hashes(self.words)


def word_hashes(words: pa.Array) -> np.ndarray:
    data, at = text_bytes(words)
    return span_hashes(data, at[:-1], at[1:])


def _pair_hash(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) ^ mix(second + lang))


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return word_hashes(pa.array([f"lang {lang}" for lang in langs], pa.string()))


def _phrases(words: pa.Array, *numbers: np.ndarray) -> pa.Array:
    parts = [words.take(pa.array(n)) for n in numbers]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))


def _batches(lang: str, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    phrases = phrases.cast(pa.string())
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(phrases), np.int64)))
    table = pa.table({"lang": langs, "phrase": phrases, "n": pa.array(counts.astype(np.int64))})
    yield from table.to_batches(max_chunksize=1 << 16)


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    for batch in batches:
        texts = field(batch, "text").cast(pa.binary())
        langs = field(batch, "lang").dictionary_encode()
        for number, lang in enumerate(langs.dictionary.to_pylist()):
            yield lang, texts.filter(pc.equal(langs.indices, number)).to_pylist()


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, phrase, n of all words and pairs of a slice of texts; the empty phrase counts all words."""
    for lang, texts in _by_lang(batches):
        for part in chunks(texts):
            tokens = Tokens(part)
            words, n = tokens.counts()
            yield from _batches(lang, pa.array([b""], pa.binary()), np.array([n.sum()]))
            yield from _batches(lang, words, n)
            first, second = tokens.pairs()
            size = len(tokens.words)
            pairs, n = np.unique(first * size + second, return_counts=True)
            yield from _batches(lang, _phrases(tokens.words, pairs // size, pairs % size), n)


ROLES = ("langs", "begins", "ends", "scores")


class Frontier:
    """Bit tables of the languages to search, and of the pairs that may begin, end or be held by a phrase to count."""

    def __init__(self, tables: np.ndarray) -> None:
        self.tables = tables  # one row of 64-bit numbers per role

    def holds(self, role: str, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.tables.shape[1] * 64 - 1)
        words = self.tables[ROLES.index(role)][(at >> np.uint64(6)).astype(np.int64)]
        return (words >> (at & np.uint64(63))) & np.uint64(1) > 0


def frontier_bits(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """role, place, bits: the 64-bit numbers of the bit tables that the rows of a frontier set."""
    for batch in batches:
        langs = _lang_hashes(field(batch, "lang").to_pylist())
        pairs = _pair_hash(langs, word_hashes(field(batch, "first")), word_hashes(field(batch, "second")))
        for number, role in enumerate(ROLES):
            hashes = langs if role == "langs" else pairs[field(batch, role).to_numpy(zero_copy_only=False)]
            at = np.unique(hashes & np.uint64(size - 1))
            if not len(at):
                continue
            place = (at >> np.uint64(6)).astype(np.int64)
            heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), heads)
            role_column = pa.array(np.full(len(heads), number, np.int32))
            yield pa.RecordBatch.from_arrays([role_column, pa.array(place[heads]), pa.array(bits.view(np.int64))], ["role", "place", "bits"])


def count_triples(batches: Iterator[pa.RecordBatch], frontier: Frontier) -> Iterator[pa.RecordBatch]:
    """lang, phrase, n of the three-word phrases of a slice of texts that the frontier asks for."""
    for lang, texts in _by_lang(batches):
        number = _lang_hashes([lang])
        if not frontier.holds("langs", number)[0]:
            continue
        for part in chunks(texts):
            tokens = Tokens(part)
            first, second, third = tokens.triples()
            if not len(first):
                continue
            size = len(tokens.words)
            # Each pair is looked up once.
            pairs, place = np.unique(np.concatenate([first * size + second, second * size + third]), return_inverse=True)
            words = tokens.hashes()
            hashes = _pair_hash(number, words[pairs // size], words[pairs % size])
            head, tail = place[: len(first)], place[len(first) :]
            begins, ends, scores = (frontier.holds(role, hashes) for role in ROLES[1:])
            asked = (begins[head] & ends[tail]) | scores[head] | scores[tail]
            triples, n = np.unique(head[asked] * size + third[asked], return_counts=True)
            pair = pairs[triples // size]
            yield from _batches(lang, _phrases(tokens.words, pair // size, pair % size, triples % size), n)


def _frontier(rows: DataFrame, n_rows: int) -> Frontier:
    """The bit tables of ``rows`` (lang, first, second and a flag per role). What comes to the driver is bounded by
    the size of the tables, not by the number of rows."""
    size = 1 << 16
    while size < min(16 * n_rows, _MOST_BITS):
        size *= 2
    numbers = rows.mapInArrow(lambda batches: frontier_bits(batches, size), "role int, place long, bits long")
    numbers = numbers.groupBy("role", "place").agg(F.bit_or("bits").alias("bits")).toArrow()
    tables = np.zeros((len(ROLES), size // 64), np.uint64)
    if numbers.num_rows:
        tables[numbers["role"].to_numpy(), numbers["place"].to_numpy()] = numbers["bits"].to_numpy().view(np.uint64)
    return Frontier(tables)


def score(a: str, left: str, right: str) -> Column:
    """floor(10**6 * a * a / (left * right)), exact for counts below 10**15."""
    a, left, right = (f"CAST({name} AS DECIMAL(15,0))" for name in (a, left, right))
    return F.expr(f"(CAST({_SCORE_UNIT} AS DECIMAL(7,0)) * {a} * {a}) div ({left} * {right})")


def scored_pairs(counts: DataFrame) -> DataFrame:
    """lang, phrase, first, second, a, l, r, score, and the bounds ``begins`` and ``ends`` of longer phrases."""
    words = counts.where("phrase <> '' and instr(phrase, ' ') = 0")
    pairs = counts.where("instr(phrase, ' ') > 0").select(
        "lang",
        "phrase",
        F.substring_index("phrase", " ", 1).alias("first"),
        F.substring_index("phrase", " ", -1).alias("second"),
        F.col("n").alias("a"),
    )
    for word, count in (("first", "l"), ("second", "r")):
        pairs = pairs.join(words.select("lang", F.col("phrase").alias(word), F.col("n").alias(count)), ["lang", word])
    return pairs.select(
        "lang", "phrase", "first", "second", "a", "l", "r", score("a", "l", "r").alias("score"),
        F.expr(f"({_SCORE_UNIT} * a) div l").alias("begins"), F.expr(f"({_SCORE_UNIT} * a) div r").alias("ends"),
    )


def floors(pairs: DataFrame, langs: DataFrame, wanted: int) -> DataFrame:
    """lang, floor: a score that at least ``wanted`` pairs of the language reach; 0 if it has fewer.

    From counts per language and power of 2**(1/16), so that a language is a few hundred rows.
    """
    level = F.when(F.col("score") > 0, F.floor(F.log2("score") * 16)).otherwise(-1)
    levels = pairs.join(langs, "lang", "left_semi").groupBy("lang", level.alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")
    )
    reached = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("level")))
    found = levels.withColumn("reached", reached).where(F.col("reached") >= wanted).groupBy("lang").agg(F.max("floor").alias("floor"))
    return langs.join(found, "lang", "left").select("lang", F.coalesce("floor", F.lit(0).cast("long")).alias("floor"))


def settled(pairs: DataFrame, triples: DataFrame, floor: DataFrame, percent: int = PERCENT) -> DataFrame:
    """lang, phrase, a, l, r, score of all surviving phrases that reach the floor of their language."""
    ends = triples.select(
        "lang", "phrase", F.col("n").alias("a"),
        F.substring_index("phrase", " ", 2).alias("head"), F.substring_index("phrase", " ", -2).alias("tail"),
    )
    held = ends.select("lang", "a", F.explode(F.array("head", "tail")).alias("phrase"))
    held = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    high = pairs.join(floor, "lang").where("score >= floor").select(columns)
    short = high.join(held, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {percent} * a").select(columns)
    head = pairs.select("lang", F.col("phrase").alias("head"), F.col("a").alias("head_n"), F.col("l").alias("first_n"))
    tail = pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("tail_n"), F.col("r").alias("last_n"))
    cut = ends.join(head, ["lang", "head"]).join(tail, ["lang", "tail"])
    cut = cut.withColumns({"one": score("a", "first_n", "tail_n"), "two": score("a", "head_n", "last_n")})
    early = F.col("one") <= F.col("two")
    long = cut.select(
        "lang", "phrase", "a", F.when(early, F.col("first_n")).otherwise(F.col("head_n")).alias("l"),
        F.when(early, F.col("tail_n")).otherwise(F.col("last_n")).alias("r"), F.least("one", "two").alias("score"),
    )
    long = long.join(floor, "lang").where("score >= floor").select(columns)
    return short.unionByName(long)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, percent: int = PERCENT
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of every language."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    schema = "lang string, phrase string, n long"
    counts = texts.mapInArrow(count_pairs, schema).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    counts = stored(counts.where(f"n >= {min_count} or phrase = ''"), "phrase-counts")
    totals = counts.where("phrase = ''").select("lang", "n")
    pairs = stored(scored_pairs(counts), "scored-pairs")

    ready, open_langs, wanted = [], stored(pairs.select("lang").distinct(), "open-languages"), 2 * top
    while not open_langs.isEmpty():
        floor = stored(floors(pairs, open_langs, wanted), "floors")
        flags = {role: F.col(role) >= F.col("floor") for role in ("begins", "ends")} | {"scores": F.col("score") >= F.col("floor")}
        rows = pairs.join(floor, "lang").withColumns(flags).where("begins or ends").select("lang", "first", "second", *ROLES[1:])
        rows = stored(rows, "frontier")
        frontier = spark.sparkContext.broadcast(_frontier(rows, rows.count()))
        triples = texts.mapInArrow(lambda batches, f=frontier: count_triples(batches, f.value), schema)
        triples = triples.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(f"n >= {min_count}")
        triples = stored(triples, "triple-counts")
        found = stored(settled(pairs, triples, floor, percent), "settled-phrases")
        reached = found.groupBy("lang").agg(F.count(F.lit(1)).alias("reached"))
        done = floor.join(reached, "lang", "left").where(f"floor = 0 or reached >= {top}").select("lang")
        done = stored(done, "finished-languages")
        ready.append(found.join(done, "lang", "left_semi"))
        open_langs = stored(open_langs.join(done, "lang", "left_anti"), "open-languages")
        wanted *= 4
    if not ready:
        ready.append(pairs.select("lang", "phrase", "a", "l", "r", "score"))
    found = ready[0]
    for more in ready[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, folder: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{folder}/documents.parquet"))


SQL = rf"""
WITH d AS (SELECT coalesce(lang, '{UNKNOWN_LANG}') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
      FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d)),
g AS (SELECT lang, m, array_to_string(list_slice(w, i + 1, i + m), ' ') AS phrase
      FROM (SELECT lang, w, m, unnest(range(len(w) - m + 1)) AS i FROM w, (VALUES (1), (2), (3)) AS x(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= {MIN_COUNT}),
cut AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
        FROM c, (VALUES (1), (2)) AS x(k) WHERE k < m),
valued AS (SELECT cut.*, l.f AS l, r.f AS r, ({_SCORE_UNIT}::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
           FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = lp JOIN f r ON r.lang = cut.lang AND r.phrase = rp),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM valued),
held AS (SELECT lang, p AS phrase, max(a) AS longer
         FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS p FROM c WHERE m = 3) GROUP BY ALL),
ranked AS (SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS place
           FROM best LEFT JOIN held ON held.lang = best.lang AND held.phrase = best.phrase
           WHERE o = 1 AND (longer IS NULL OR 100 * longer < {PERCENT} * a))
SELECT ranked.lang, place AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE place <= {TOP}
"""
