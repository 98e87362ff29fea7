"""Benchmark decontamination by winnowing, on built-in functions only.

Of every ``WINDOW - GRAM + 1`` neighbouring word-gram hashes a text keeps the smallest, so any two texts
that share ``WINDOW`` words in a row share a kept hash. Documents whose hashes meet a benchmark hash are
read again; there every meeting gram fixes how the two texts lie on each other, and the hit is extended to
all windows that agree word by word in that position. Items shorter than a window are found by the hash
of all their words instead, for which documents also post all grams of those few lengths.

Rows with one doc_id and one text share their result; rows with one doc_id and other texts are separate.
A null or empty text has no words: nothing hit, not contaminated. Items without words have no window, and
an item without id is named by the empty string. Other columns are ignored. An empty table gives an empty result; a
very long text is one array of words, read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billmill.llm.steps import stored

WINDOW = 13
GRAM = 6
CONTAMINATED = 20  # contaminated where 20 * n_hit >= n_words

_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-case (A-Z only) runs of letters, digits and characters beyond ASCII."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # Both give the same for plain ASCII, where the first is faster.
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )
    return F.array_remove(F.split(lowered, _SEPARATOR), "")


def _grams(hashes: str, size: int) -> Column:
    """A hash of each ``size`` neighbours in the array column ``hashes``."""
    gram = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - size),
        lambda i: F.xxhash64(F.lit(size), *[F.get(F.col(hashes), i + j) for j in range(size)]),
    )
    return F.when(F.size(hashes) >= size, gram).otherwise(F.array().cast("array<bigint>"))


def _winnowed(grams: str, width: int) -> Column:
    """The smallest of every ``width`` neighbours; of all, where there are fewer."""
    least = F.transform(
        F.sequence(F.lit(1), F.size(grams) - (width - 1)),
        lambda i: F.array_min(F.slice(F.col(grams), i, width)),
    )
    few = F.array_compact(F.array(F.array_min(F.col(grams))))
    return F.array_distinct(F.when(F.size(grams) >= width, least).otherwise(few))


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def fingerprints(df: DataFrame, short: list[int], window: int, gram: int) -> DataFrame:
    """Adds ``marks``: the winnowed hashes of ``words`` and all grams of the lengths in ``short``."""
    rest = df.columns
    df = _hashed(df).withColumn("grams", _grams("hashes", gram))
    marks = [_winnowed("grams", window - gram + 1), *[_grams("hashes", n) for n in short]]
    return df.select(*rest, F.array_distinct(F.concat(*marks)).alias("marks"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_words, n_hit, n_items, items (sorted ids), contaminated."""
    tests = stored(
        items.select(
            F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"),
            words_of(F.col(item_text)).alias("words"),
        ).where(F.size("words") > 0),
        "items",
    )
    # At most window - 1 lengths come back.
    lengths = tests.select(F.size("words").alias("n")).where(F.col("n") < window).distinct()
    short = sorted(row.n for row in lengths.collect())
    size = F.least(F.size("words"), F.lit(window))
    posted = _hashed(tests.withColumn("size", size))
    sizes = F.when(F.col("size") == window, F.lit(gram)).otherwise(F.col("size"))
    item_grams = stored(
        posted.withColumn("of", sizes)
        .select(
            "item_id",
            "words",
            "size",
            F.posexplode(
                F.coalesce(*[F.when(F.col("of") == n, _grams("hashes", n)) for n in sorted({gram, *short})])
            ).alias("place", "mark"),
        ),
        "item-grams",
    )

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    keyed = texts.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        words_of(F.col("text")).alias("words"),
    )
    marked = stored(
        fingerprints(keyed, short, window, gram).select("doc_id", "text_hash", F.size("words").alias("n_words"), "marks"),
        "marks",
    )
    candidates = stored(
        marked.select("doc_id", "text_hash", F.explode("marks").alias("mark"))
        .join(item_grams.select("mark").distinct(), "mark")
        .select("doc_id", "text_hash")
        .distinct(),
        "candidates",
    )
    wanted = candidates.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"))
    again = (
        texts.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left_semi")
        .dropDuplicates(["doc_id", "text_hash"])
        .select("doc_id", "text_hash", words_of(F.col("text")).alias("doc_words"))
        .withColumn("hashes", F.transform("doc_words", lambda w: F.xxhash64(w)))
    )
    again = stored(again, "candidate-words")
    all_grams = [
        again.select("doc_id", "text_hash", F.posexplode(_grams("hashes", n)).alias("at", "mark"))
        for n in sorted({gram, *short})
    ]
    met = all_grams[0]
    for more in all_grams[1:]:
        met = met.unionByName(more)
    laid = (
        met.join(item_grams, "mark")
        .select("doc_id", "text_hash", "item_id", "words", "size", (F.col("at") - F.col("place")).alias("shift"))
        .distinct()
        .withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    )
    # Every window of the item that the document repeats in this position.
    first = F.greatest(F.lit(0), -F.col("shift"))
    last = F.least(F.size("words"), F.size("doc_words") - F.col("shift")) - F.col("size")
    agreeing = F.filter(
        F.sequence(first, last),
        lambda j: F.slice("doc_words", j + F.col("shift") + 1, F.col("size")) == F.slice("words", j + 1, F.col("size")),
    )
    hits = stored(
        laid.join(again, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")))
        .where(last >= first)
        .select("doc_id", "text_hash", "item_id", "shift", "size", F.explode(agreeing).alias("j"))
        .select("doc_id", "text_hash", "item_id", (F.col("j") + F.col("shift")).alias("at"), "size"),
        "hits",
    )
    keys = ["doc_id", "text_hash"]
    hit_words = (
        hits.select(*keys, "at", "size").distinct()
        .select(*keys, F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("word"))
        .distinct()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = hits.select(*keys, "item_id").distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("item_id")).alias("items"))

    def same(table: DataFrame, n: int) -> tuple[DataFrame, Column]:
        table = table.withColumnsRenamed({k: f"_{k}{n}" for k in keys})
        return table, F.col("doc_id").eqNullSafe(F.col(f"_doc_id{n}")) & (F.col("text_hash") == F.col(f"_text_hash{n}"))

    found = marked.select(*keys, "n_words").join(*same(stored(hit_words, "hit-words"), 1), "left")
    found = found.join(*same(stored(named, "named"), 2), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    held = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        *keys,
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(held).cast("long").alias("n_items"),
        held.alias("items"),
        ((n_hit > 0) & (CONTAMINATED * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op5_decontaminate(spark, folder: str) -> DataFrame:
    found = decontaminate(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    )
    listed = F.sha2(F.array_join("items", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), "contaminated"
    )


_SQL_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS n,
         array_to_string(list_slice(w, i + 1, i + least({WINDOW}, len(w))), ' ') AS s
       FROM (SELECT item, w, unnest(range(len(w) - least({WINDOW}, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, n, array_to_string(list_slice(w, i + 1, i + n), ' ') AS s
       FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, i, n, item FROM dw JOIN bw USING (n, s)),
pos AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {CONTAMINATED} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
