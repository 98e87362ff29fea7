"""N-gram Jaccard join by groups of similar documents.

1. Each text becomes its set of word shingles (64-bit hashes). Equal sets are one member, named by the
   smallest doc_id that has it.
2. Members that share a minimum hash are compared with the most central member of that bucket only; what
   proves similar forms a group. A large group of near copies costs one comparison per member and bucket.
3. The token-group matrix: members post the part of their set that every similar set must meet (the rarest
   shingles, by a bounded table of counts over all documents); a group posts the union of its members'
   tokens once per token. Tokens that only one group posts end here.
4. A member's overlap with a group is bounded from the shared tokens. Only a group whose bound reaches the
   threshold is opened, and the member is compared with those of its members that fit in size.

Links found in 2 and 4 connect the same documents as all links do: a pair is left out only if its two
sides are already connected or a bound rules it out. No bucket, group or partner list is capped.

Rows with one doc_id count as one document: they are reached together. Rows without doc_id, without text
or without words link with nothing; they are their own component. Other columns are ignored. An empty table gives an
empty result; a very long text is a slice of its own, and its set is held by one task at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billmill.llm.components import connected_components
from billmill.llm.steps import settled, stored
from billmill.llm.words import LOWER, WHITE, Words, field, mix, slices, text_bytes, windows

SHINGLE, PERCENT = 5, 80
BUCKETS = 12  # minimum hashes per member
CELLS = 1 << 16  # counters of the frequency table, whatever the size of the corpus
HOT_SHARE = 1000
BLOCK = 256  # partners compared with one member in one step


def shingle_sets(batch: pa.RecordBatch, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, at = text_bytes(field(batch, "text"))
    words = Words(LOWER[data], at, WHITE)
    hashes = words.hashes()
    whole = windows(hashes, size)
    few = {n: windows(hashes, n) for n in range(1, size) if (words.counts == n).any()}
    out = []
    for first, count in zip(words.firsts.tolist(), words.counts.tolist()):
        if count >= size:
            out.append(np.unique(whole[first : first + count - size + 1]))
        else:
            out.append(few[count][first : first + 1] if count else np.zeros(0, np.uint64))
    return out


def _least_overlap(n: int, percent: int) -> int:
    """Elements of a set of n that every similar set shares with it."""
    return -(-percent * n // 100)


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def token_counts(texts: DataFrame, size: int) -> np.ndarray:
    """How often the tokens of each of ``CELLS`` cells occur in all texts (CELLS numbers come back)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch, size)
            counts += np.bincount(_cell(np.concatenate([*sets, np.zeros(0, np.uint64)])), minlength=CELLS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["cell", "n"])

    rows = texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(CELLS, np.int64)
    found = rows.toArrow()
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    return counts


def members(texts: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """doc_id, n, set_a and set_b (a 128-bit name of the set), ``buckets`` and ``tokens`` (rarest first)."""
    place = np.empty(CELLS, np.uint64)
    place[np.argsort(counts, kind="stable")] = np.arange(CELLS, dtype=np.uint64)
    seeds = mix(np.arange(1, BUCKETS + 1, dtype=np.uint64) << np.uint64(32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch, size)
            n = np.array([len(s) for s in sets], np.int64)
            # one stand-in element keeps every run non-empty
            flat = np.concatenate([s if len(s) else np.zeros(1, np.uint64) for s in sets])
            starts = np.concatenate([[0], np.cumsum(np.maximum(n, 1))[:-1]])
            spread = mix(flat)
            named = [np.add.reduceat(x, starts).view(np.int64) for x in (spread, mix(spread ^ seeds[0]))]
            least = [np.minimum.reduceat(mix(flat ^ s), starts).view(np.int64) for s in seeds]
            order = (place[_cell(flat)] << np.uint64(48)) | (spread >> np.uint64(16))
            tokens = []
            for s, first in zip(sets, starts.tolist()):
                k = len(s) - _least_overlap(len(s), percent) + 1 if len(s) else 0
                tokens.append(s[np.argsort(order[first : first + len(s)])[:k]])
            at = np.cumsum([0, *[len(t) for t in tokens]]).astype(np.int32)
            buckets = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(least, 1).reshape(-1)), BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [
                    field(batch, "doc_id"),
                    pa.array(n),
                    *map(pa.array, named),
                    buckets.cast(pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(
                        pa.array(at), pa.array(np.concatenate([*tokens, np.zeros(0, np.uint64)]).view(np.int64))
                    ),
                ],
                ["doc_id", "n", "set_a", "set_b", "buckets", "tokens"],
            )

    schema = "doc_id long, n long, set_a long, set_b long, buckets array<long>, tokens array<long>"
    return texts.mapInArrow(run, schema)


def _fits(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts link, from the texts themselves.

    The partners of one ``a`` are cut into blocks, so a member with very many partners is many tasks' work.
    A block holds the text of ``a`` once and is streamed: a task keeps one text's set at a time.
    """
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    one = pairs.join(blocks, "a").select(
        F.col("b").alias("doc"), "a", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("block"), F.lit(1).alias("side")
    )
    other = blocks.select(
        F.col("a").alias("doc"), "a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side")
    )
    wanted = stored(one.unionByName(other), "wanted")
    # The selective-looking filter lets Spark build a Bloom filter of the wanted ids and prune texts early.
    wanted = wanted.where("side < 2")
    fetched = texts.join(wanted, texts["doc_id"] == wanted["doc"]).select("a", "block", "side", "doc", "text")
    placed = fetched.repartition("a", "block").sortWithinPartitions("a", "block", "side", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own = None, []
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch, size)
            a, block, side, doc = (field(batch, c).to_pylist() for c in ("a", "block", "side", "doc"))
            found = []
            for i, theirs in enumerate(sets):
                if (a[i], block[i]) != here:
                    here, own = (a[i], block[i]), []
                if side[i] == 0:
                    own.append(theirs)
                    continue
                for mine in own:
                    least, most = sorted((len(mine), len(theirs)))
                    if least == 0 or 100 * least < percent * most:
                        continue
                    common = len(np.intersect1d(mine, theirs, assume_unique=True))
                    if 100 * common >= percent * (len(mine) + len(theirs) - common):
                        found.append((a[i], doc[i]))
                        break
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())}
            )

    spark, names = texts.sparkSession, "spark.sql.optimizer.runtime.bloomFilter."
    threshold = f"{names}applicationSideScanSizeThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "1MB")
    try:
        return stored(placed.mapInArrow(run, "a long, b long").distinct(), "links")
    finally:
        spark.conf.set(threshold, before)


def bucket_pairs(reps: DataFrame, percent: int) -> DataFrame:
    """Each member with the most central member of every bucket it is in.

    Central is who shares the most bucket entries with others: of near copies, the one that the others were
    made from or one close to it. A copy may miss the threshold to another copy and still reach that one.
    """
    key = ["nth", "bucket"]
    inside = reps.select("rep", "n", F.posexplode("buckets").alias("nth", "bucket"))
    crowded = inside.groupBy(key).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    crowded = stored(crowded, "crowded-buckets")
    # A bucket of at least one in HOT_SHARE of all members: there are at most BUCKETS * HOT_SHARE of these, so they
    # are broadcast, and their members never meet in one task.
    is_hot = F.col("members") * HOT_SHARE >= F.lit(reps.count())
    hot, other = crowded.where(is_hot), crowded.where(~is_hot)
    within_hot = inside.join(F.broadcast(hot), key)
    elsewhere = inside.join(F.broadcast(hot.select(key)), key, "left_anti").join(other, key)
    inside = stored(within_hot.unionByName(elsewhere), "buckets")
    central = inside.groupBy("rep").agg(F.sum("members").alias("shared"))
    first = (
        inside.join(central, "rep")
        .groupBy(key)
        .agg(F.max(F.struct("shared", (-F.col("rep")).alias("rep"), "n")).alias("first"), F.max("members").alias("members"))
    )
    first = stored(first, "central-members")
    columns = [*key, "first"]
    met_hot = inside.where(is_hot).join(F.broadcast(first.where(is_hot).select(columns)), key)
    pairs = met_hot.unionByName(inside.where(~is_hot).join(first.where(~is_hot).select(columns), key)).where("rep <> -first.rep")
    return pairs.where(_fits(F.col("n"), F.col("first.n"), percent)).select(
        (-F.col("first.rep")).alias("a"), F.col("rep").alias("b")
    )


def group_pairs(marked: DataFrame, reps: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The pairs of members of different groups that the token-group matrix cannot rule out."""
    grouped = groups.withColumnsRenamed({"node": "rep", "component": "joined"})
    known = stored(
        reps.select("rep", "set_a", "set_b", "n")
        .join(grouped, "rep", "left")
        .select("rep", "set_a", "set_b", "n", F.coalesce("joined", "rep").alias("grp"), F.col("joined").isNull().alias("alone")),
        "grouped",
    )
    # Two similar sets meet within the posted tokens of the larger and the first `indexed` of the smaller.
    indexed = F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1
    posts = (
        marked.select(F.col("doc_id").alias("rep"), "set_a", "set_b", "tokens")
        .join(known, ["rep", "set_a", "set_b"])
        .select("rep", "n", "grp", "alone", F.posexplode("tokens").alias("at", "token"))
        .withColumn("strong", F.col("at") < indexed)
    )
    alone = posts.where("alone").select("token", "grp", "strong")
    joined = posts.where("not alone").groupBy("token", "grp").agg(F.max("strong").alias("strong"))
    # The matrix keeps the tokens of two groups or more.
    of_token = Window.partitionBy("token")
    matrix = alone.unionByName(joined).withColumns(
        {"low": F.min("grp").over(of_token), "high": F.max("grp").over(of_token)}
    )
    matrix = stored(matrix.where("low < high").select("token", "grp", "strong"), "token-groups")
    sizes = known.groupBy("grp").agg(F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.max("alone").alias("alone"))
    solo = sizes.where("alone and n_low = n_high").select(F.col("grp").alias("rep"), "grp", F.col("n_low").alias("n"))
    # A lone doc_id with sets of several sizes asks with each of them.
    several = sizes.where("alone and n_low < n_high").select("grp", F.lit(True).alias("several"))
    asking = posts.where("not alone").unionByName(posts.where("alone").join(several, "grp", "left_semi"))
    queries = stored(
        matrix.join(solo, "grp")
        .select("token", "grp", "rep", "n", "strong")
        .unionByName(
            asking.join(matrix.select("token").distinct(), "token").select("token", "grp", "rep", "n", "strong")
        ),
        "queries",
    )
    theirs = matrix.join(sizes, "grp").select(
        "token", F.col("grp").alias("other"), F.col("strong").alias("other_strong"), "n_low", "n_high"
    )
    possible = (
        queries.join(theirs, "token")
        .where("grp <> other and other_strong and n_low <= n")
        .where(100 * F.col("n_high") >= percent * F.col("n"))
        .select("rep", "n", "grp", "other", "n_low", "n_high")
        .distinct()
    )
    possible = stored(possible, "possible")
    # Tokens that member and group share among those posted, against what a similar pair of the smallest
    # allowed size needs: the rest of the larger set can add no more than its unposted tokens.
    shared = (
        possible.join(queries.select("rep", "token"), "rep")
        .join(matrix.select("token", F.col("grp").alias("other")), ["token", "other"], "left_semi")
        .groupBy("rep", "n", "other", "n_low", "n_high")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    least = F.greatest("n_low", F.ceil(F.col("n") * percent / 100))
    needed = F.ceil((F.col("n") + least) * percent / (100 + percent))
    unposted = F.ceil(F.col("n") * percent / 100) - 1
    opened = shared.where(F.col("shared") + unposted >= needed)
    inside = known.select(F.col("grp").alias("other"), F.col("rep").alias("b"), F.col("n").alias("n_b"))
    return (
        opened.join(inside, "other")
        .where("n_b < n or (n_b = n and b < rep)")
        .where(_fits(F.col("n"), F.col("n_b"), percent))
        .select(F.col("rep").alias("a"), "b")
    )


def jaccard_join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = stored(members(texts, token_counts(texts, size), size, percent), "members")
    named = marked.where("n > 0 and doc_id is not null")
    sets = named.groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("rep"))
    sets = stored(sets, "sets")
    reps = stored(
        named.select(F.col("doc_id").alias("rep"), "set_a", "set_b", "n", "buckets")
        .dropDuplicates(["rep", "set_a", "set_b"])
        .join(sets.drop("n"), ["rep", "set_a", "set_b"], "left_semi"),
        "reps",
    )
    texts = texts.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    first = settled(lambda: verify(bucket_pairs(reps, percent), texts, size, percent))
    # Several sets of one doc_id are reached together.
    several = named.groupBy("doc_id").agg(F.min("set_a").alias("x"), F.max("set_a").alias("y")).where("x <> y")
    same_id = named.join(several.select("doc_id"), "doc_id").join(sets.drop("n"), ["set_a", "set_b"])
    bridges = same_id.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = first.unionByName(bridges)
    groups = settled(lambda: stored(connected_components(links, "a", "b"), "groups"))
    second = settled(lambda: verify(group_pairs(marked, reps, groups, percent), texts, size, percent))
    between = (
        second.join(groups.withColumnsRenamed({"node": "a", "component": "x"}), "a", "left")
        .join(groups.withColumnsRenamed({"node": "b", "component": "y"}), "b", "left")
        .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    )
    merged = settled(lambda: stored(connected_components(between, "a", "b"), "merged"))
    final = sets.join(groups.withColumnsRenamed({"node": "rep", "component": "grp"}), "rep", "left").withColumn(
        "grp", F.coalesce("grp", "rep")
    )
    final = final.join(merged.withColumnsRenamed({"node": "grp"}), "grp", "left").select(
        "set_a", "set_b", F.coalesce("component", "grp").alias("component_id")
    )
    final = stored(final, "components")
    return (
        marked.join(final, ["set_a", "set_b"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def op1_jaccard_join(spark, folder: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{folder}/documents.parquet"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# For tables whose doc_id is a key. Compares all pairs that share a shingle, so for small tables only.
SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i + 1, i + {SHINGLE}), ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - {SHINGLE} + 1, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (t) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * shared >= {PERCENT} * (x.n + y.n - shared)),
reach AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(min(other), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id, n.n
"""
