"""Secret scans with corpus-wide ownership, on built-in functions only.

Candidates are found by pattern; their places come from the lengths of the matches and of the text between
them. Equal values are then counted over the corpus by distinct document (equal texts are one document) and by
distinct owner (the ``source`` of a document). A value in many documents, or of several owners, is a copied
example; a second owner that holds only copies of the first one's documents does not count. A value that is
not copied and that looks random is taken for a live credential. The base kinds (assign, access, hex) are always reported; the ownership
decides which candidates of the wider kinds (prefixed, key block, opaque) become spans as well.

A key block reaches from its header to its END line, however long and whatever stands between but another such line
or five dashes; header and END line are found by pattern, the block is what lies between two neighbours.

Rows with one doc_id and one text share their result. A null or empty text has no spans, an empty table gives an empty
result. A null source is an owner of its own. Places count code points, ends are exclusive. All work on a very long
text is linear in its length and its spans. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billmill.llm.steps import stored

# Kind -> pattern and least length of the value. The order is the order of spans that start together.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    "access": (r"AKIA[A-Z0-9]+", 20),
    # A run of these letters is matched as a whole, so the least length can be part of the pattern.
    "hex": (r"[0-9a-f]{24,}", 24),
}
WIDER = {
    "prefixed": (r"(?:gh[opsur]_|github_pat_|glpat-|xox[abps]-|sk-|AIza)[A-Za-z0-9_-]{20,}", 24),
    # The lines around a block; the least length is that of its body.
    "keyblock": (r"-----(?:BEGIN|END) [A-Z ]*PRIVATE KEY-----", 24),
    "opaque": (r"[A-Za-z0-9+/_-]{24,}", 24),
}
KINDS = [*BASE, *WIDER]
LIVE_OWNERS = 1  # a value that more owners hold is a copied example,
COPY_OWNERS = 2  # or more than these, if all its documents are found with one of them
LIVE_DOCUMENTS = 20  # a value in more distinct documents is a copied example, also of one owner
DISTINCT_CHARACTERS = 10  # of a value that looks random


def _matches(text: str, kind: str, pattern: str) -> Column:
    """The matches of one kind, the lengths of the text before each, and for key blocks the text after each."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    between = F.split(F.col(text), pattern, -1)
    gaps = F.transform(between, lambda g: F.char_length(g))
    after = F.slice(between, 2, F.size(found)) if kind == "keyblock" else F.array().cast("array<string>")
    pairs = F.arrays_zip(found.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"), after.alias("after"))
    named = F.transform(
        pairs, lambda p: F.struct(p["value"].alias("value"), p["gap"].alias("gap"), p["after"].alias("after"))
    )
    empty = F.array().cast("array<struct<value:string,gap:int,after:string>>")
    return F.struct(F.lit(kind).alias("kind"), F.when(F.col(text).rlike(pattern), named).otherwise(empty).alias("found"))


def candidates(docs: DataFrame, doc_id: str, text: str, owner: str) -> DataFrame:
    """One row per match: doc_id, text_hash, owner, kind, start, end, value, secret."""
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.col(owner).cast("string").alias("owner"),
    )
    kinds = BASE | WIDER
    matched = texts.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        "owner",
        F.explode(F.array(*[_matches("text", kind, pattern) for kind, (pattern, _) in kinds.items()])).alias("k"),
    ).select("doc_id", "text_hash", "owner", "k.kind", F.posexplode("k.found").alias("nth", "m"))
    matched = stored(matched.select("doc_id", "text_hash", "owner", "kind", "nth", "m.gap", "m.value", "m.after"), "matches")
    in_order = Window.partitionBy("doc_id", "text_hash", "owner", "kind").orderBy("nth")
    end = F.sum(F.col("gap") + F.char_length("value")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    once = matched.dropDuplicates(["doc_id", "text_hash", "owner", "kind", "nth"])
    placed = once.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("value"))
    # A header whose next line of this kind is an END line opens a block.
    block = F.col("kind") == "keyblock"
    following = {"next": F.lead("value").over(in_order), "next_end": F.lead("end").over(in_order)}
    opens = F.col("value").startswith("-----BEGIN") & F.col("next").startswith("-----END") & ~F.col("after").contains("-----")
    placed = placed.withColumns(following).where(~block | F.coalesce(opens, F.lit(False)))
    placed = placed.withColumn("end", F.when(block, F.col("next_end")).otherwise(F.col("end")))
    # What is compared over the corpus: of an assignment, the assigned value; of a key block, its body, however
    # the lines are broken.
    secret = (
        F.when(F.col("kind") == "assign", F.regexp_extract("value", BASE["assign"][0], 2))
        .when(block, F.regexp_replace("after", r"\s|\\[nr]", ""))
        .otherwise(F.col("value"))
    )
    least = F.create_map(*[F.lit(x) for kind, (_, n) in kinds.items() for x in (kind, n)])
    placed = placed.withColumn("secret", secret).where(F.char_length("secret") >= least[F.col("kind")])
    return placed.select("doc_id", "text_hash", "owner", "kind", "start", "end", "secret")


def looks_random(value: Column, kind: Column) -> Column:
    """Digits, letters and many different characters; both cases too where the pattern asks for little.

    A key block needs no digits.
    """
    mixed = (value.rlike("[0-9]") | (kind == "keyblock")) & value.rlike("[A-Za-z]")
    cased = value.rlike("[A-Z]") & value.rlike("[a-z]")
    varied = F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT_CHARACTERS
    return mixed & varied & ((kind != "opaque") | cased)


def ownership(found: DataFrame) -> DataFrame:
    """Per value: its distinct documents (texts), its owners, and the documents of the owner that holds most.

    Counted per document and per owner first, so a hot value is few rows per task in the last step.
    """
    held = found.groupBy("secret_hash", "text_hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    per_owner = held.groupBy("secret_hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    per_text = held.groupBy("secret_hash", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    owners = per_owner.groupBy("secret_hash").agg(F.count(F.lit(1)).alias("n_owners"), F.max("n").alias("n_most"))
    documents = per_text.groupBy("secret_hash").agg(F.count(F.lit(1)).alias("n_documents"))
    return owners.join(documents, "secret_hash")


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", live_owners: int = LIVE_OWNERS
) -> DataFrame:
    """One row per document row that holds a span: doc_id, text_hash, owner, ``spans`` (array of kind, start,
    end, base, n_owners, live, copied), sorted by start and kind."""
    found = candidates(docs, doc_id, text, owner).withColumn("secret_hash", F.sha2("secret", 256))
    found = stored(
        found.withColumn("random", looks_random(F.col("secret"), F.col("kind"))).drop("secret"), "candidates"
    )
    judged = found.join(ownership(found), "secret_hash")
    one_source = (F.col("n_owners") <= COPY_OWNERS) & (F.col("n_most") == F.col("n_documents"))
    copied = (F.col("n_documents") > LIVE_DOCUMENTS) | ((F.col("n_owners") > live_owners) & ~one_source)
    order = F.create_map(*[F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, i)])
    judged = judged.withColumn("copied", copied).withColumns(
        {
            "rank": order[F.col("kind")],
            "base": F.col("kind").isin(*BASE),
            "live": ~F.col("copied") & F.col("random"),
        }
    ).where(F.col("base") | F.col("live"))
    # Wider spans that touch base ones or key blocks add nothing and go first; key blocks stay, as a base span can
    # cover no more than a part of one. Of the others the first of those that overlap stays. Runs of one kind lie
    # apart, and a prefixed value lies within one opaque run: an opaque span goes if a prefixed one starts with it,
    # and a prefixed one if it lies in an opaque span that stays.
    in_doc = Window.partitionBy("doc_id", "text_hash", "owner").orderBy("start", "rank")
    before = in_doc.rowsBetween(Window.unboundedPreceding, -1)
    # The rows behind, as the rows before in the other order: a frame to the end would be made anew for every row.
    behind = Window.partitionBy("doc_id", "text_hash", "owner").orderBy(F.desc("start"), F.desc("rank"))
    after = behind.rowsBetween(Window.unboundedPreceding, -1)

    def apart(firm: Column) -> Column:
        reached, following = F.max(F.when(firm, F.col("end"))).over(before), F.min(F.when(firm, F.col("start"))).over(after)
        return (F.coalesce(reached, F.lit(0)) <= F.col("start")) & (following.isNull() | (following >= F.col("end")))

    kept = judged.withColumn("firm", F.col("base") | (F.col("kind") == "keyblock"))
    kept = kept.withColumn("stays", F.col("firm") | apart(F.col("firm"))).where("stays")
    for kind, over in (("opaque", "prefixed"), ("prefixed", "opaque")):
        reached = F.coalesce(F.max(F.when(F.col("kind") == over, F.col("end"))).over(before), F.lit(0))
        kept = kept.withColumn("stays", (F.col("kind") != kind) | (reached <= F.col("start"))).where("stays")
    # How far the spans up to each one reach, for readers that cut the text between them.
    kept = kept.withColumn("reach", F.max("end").over(in_doc.rowsBetween(Window.unboundedPreceding, 0)))
    span = F.struct("start", "rank", "end", "kind", "base", "n_owners", "live", "copied", "reach")
    return kept.groupBy("doc_id", "text_hash", "owner").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def with_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source"
) -> DataFrame:
    """Every row of ``docs``, unchanged, with its ``_spans`` (NULL where there are none)."""
    spans = stored(scan(docs, doc_id, text, owner), "spans").withColumnsRenamed(
        {"doc_id": "_doc", "text_hash": "_hash", "owner": "_owner", "spans": "_spans"}
    )
    same = (
        F.col(doc_id).cast("long").eqNullSafe(F.col("_doc"))
        & F.col(owner).cast("string").eqNullSafe(F.col("_owner"))
        & (F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))) == F.col("_hash"))
    )
    return docs.join(spans, same, "left").drop("_doc", "_hash", "_owner")


_CHUNK = 4096


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", doc_id: str = "doc_id", owner: str = "source") -> DataFrame:
    """The same rows and columns with every span in ``text`` replaced by ``mark``.

    Overlapping spans become one. Text without spans is left as it is. A text is cut into chunks once, and each piece
    between spans is taken from its chunks, so the work grows with the text and the spans, not with their product.
    """
    columns = docs.columns
    joined = with_spans(docs, doc_id, text, owner)
    # The explode of one element keeps the chunks a column: they are made once per row.
    chunks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))
    chunks = F.when(F.col("_spans").isNotNull(), chunks).otherwise(F.array().cast("array<string>"))
    joined = joined.select("*", F.explode(F.array(chunks)).alias("_chunks"))
    # The pieces between spans: each begins where all spans before it have ended.
    reach = F.transform(F.col("_spans"), lambda s: s["reach"].cast("bigint"))
    ends = F.concat(F.array(F.lit(0)).cast("array<bigint>"), reach)
    starts = F.concat(
        F.transform(F.col("_spans"), lambda s: s["start"].cast("bigint")),
        F.array(F.char_length(F.col(text)).cast("bigint")),
    )
    cuts = F.filter(F.arrays_zip(ends.alias("e"), starts.alias("s")), lambda c: c["s"] >= c["e"])
    joined = joined.select("*", F.explode(F.array(cuts)).alias("_cuts"))

    def piece(cut: Column) -> Column:
        first = F.floor(cut["e"] / _CHUNK)
        last = F.floor(F.greatest(cut["s"] - 1, cut["e"]) / _CHUNK)
        held = F.array_join(F.slice("_chunks", (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return F.substring(held, (cut["e"] - first * _CHUNK + 1).cast("int"), (cut["s"] - cut["e"]).cast("int"))

    clean = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(F.array_join(F.transform("_cuts", piece), mark))
    return joined.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in columns])


def op10_secrets(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    narrow = docs.select("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    spans = stored(scan(docs), "spans").withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash", "owner": "_owner"})
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc"))
        & F.col("source").eqNullSafe(F.col("_owner"))
        & (F.col("text_hash") == F.col("_hash"))
    )
    none = F.array().cast(spans.schema["spans"].dataType)
    rows = narrow.join(spans, same, "left").select("doc_id", F.coalesce("spans", none).alias("spans"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    return rows.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(listed(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        live.alias("n_live"),
        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"),
    )
