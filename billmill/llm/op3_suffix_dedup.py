"""Removal of repeated passages by sorting sampled suffixes.

A difference cover picks sample positions so that any two suffixes have a sampled position at one common
distance. Its smallest form samples two thirds of all positions; here the sample is chosen by content
instead: of every window of ``length`` bytes the position of its smallest k-gram hash. Equal windows pick
the same position, which is the property the cover is there for, with 3 % of all positions.

1. Sample: every sampled position with the windows that picked it and the name (hash) of the text they span.
2. Sort by (k-gram, name, document, place). A position whose neighbour before it has the same k-gram and
   name repeats all its windows.
3. Remaining windows: where positions share a k-gram but not the whole text around it, the windows of the
   first position of each name are named one by one, sorted and compared with the neighbour before.
4. The bytes of all repeated windows are removed from their documents.

Earlier means smaller doc_id, then smaller start. Rows that share a doc_id come in the order of a 15-bit
hash of their text; equal rows share one result. A row without doc_id has no place in the order: nothing is
removed from it or because of it. Null and empty texts, and texts shorter than a window, stay as they are.
Other columns are ignored. Matches never cross documents. An empty table gives an empty result; a very long text is
cut into overlapping pieces, so that no window is missed and no task holds its hashes at once. Copies within a slice of texts are found on the
spot, so a name that is everywhere is one row per slice; the rest of its group is sorted and streamed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billmill.llm.steps import stored
from billmill.llm.words import SLICE_BYTES, _BYTE_VALUES, field, mix, powers, slices, text_bytes

LENGTH = 100
GRAM = 32
TIES = 1 << 15
_BASES = (0xD6E8FEB86659FD93, 0xA24BAED4963EE407)  # of two independent hashes


class Rolling:
    """Hashes of any stretch of ``data`` in constant time."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        n, base = len(data), _BASES[which]
        if which not in Rolling._powers or len(Rolling._powers[which][0]) <= n:
            size = max(n + 1, 1 << 12)
            Rolling._powers[which] = powers(base, size), powers(pow(base, -1, 1 << 64), size)
        up, self._down = Rolling._powers[which]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[:n], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[starts + lengths] - self.sums[starts]) * self._down[starts])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` neighbours the place of its smallest value, the leftmost of equal ones."""
    least, place, size = values, np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        n = len(least) - step
        later = least[step:] < least[:n]
        least = np.where(later, least[step:], least[:n])
        place = np.where(later, place[step:], place[:n])
        size += step
    return place


def sample(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Sampled positions: k-gram, name, text, first window start, last window start, distance to the first."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty, empty
    rolling = Rolling(data)
    grams = rolling(np.arange(len(data) - gram + 1), gram)
    place = _smallest(grams, length - gram + 1)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(place)]
    start = np.flatnonzero(np.arange(len(place)) + length <= at[owner + 1])
    if not len(start):
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty, empty
    place, owner = place[start].astype(np.int64), owner[start]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
    heads = np.flatnonzero(new)
    first, last = start[heads], start[np.concatenate([heads[1:], [len(start)]]) - 1]
    place, owner = place[heads], owner[heads]
    name = mix(rolling(first, last - first + length) ^ mix((place - first).astype(np.uint64)))
    return grams[place], name, owner, first - at[owner], last - at[owner], place - first


def _pieces(data: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The texts, or overlapping pieces of one very long text with their place in it."""
    if len(data) <= 4 * SLICE_BYTES:
        yield data, at, 0
        return
    for place in range(0, len(data) - length + 1, SLICE_BYTES):
        piece = data[place : place + SLICE_BYTES + length - 1]
        yield piece, np.array([0, len(piece)]), place


def _spot(tie: np.ndarray, start: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Tie, start and a small number in one: ordered by tie and start."""
    return tie << 48 | start << 16 | rest


def _start(spot: np.ndarray) -> np.ndarray:
    return spot >> 16 & 0xFFFFFFFF


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    tie = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(TIES)).cast("long")
    return texts.withColumn("tie", tie)


def _copies_here(key: np.ndarray, doc: np.ndarray, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which positions of a slice repeat an earlier one of it, and a key that spreads them.

    Only the first position of a key goes on under it, so a key that holds a third of all positions is a few
    rows per slice. The others are known to be copies; a key of their own keeps them out of the way.
    """
    order = np.lexsort((spot, doc))
    order = order[np.argsort(key[order], kind="stable")]
    key_, doc_, spot_ = key[order], doc[order], spot[order]
    heads = np.flatnonzero(np.concatenate([[True], key_[1:] != key_[:-1]]))
    first = np.repeat(heads, np.diff(np.concatenate([heads, [len(key)]])))
    copy = np.zeros(len(key), bool)
    copy[order] = (doc_ != doc_[first]) | (spot_ != spot_[first])
    return copy, mix(key ^ mix(spot.view(np.uint64)) ^ mix(mix(doc.view(np.uint64))))


def sampled(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = text_bytes(field(batch, "text"))
            doc, tie = field(batch, "doc_id").to_numpy(), field(batch, "tie").to_numpy()
            for piece, cut, place in _pieces(data, at, length):
                grams, name, owner, first, last, _ = sample(piece, cut, length, gram)
                if not len(grams):
                    continue
                spot = _spot(tie[owner], first + place, last - first)
                copy, own = _copies_here(mix(grams ^ mix(name)), doc[owner], spot)
                grams = np.where(copy, own, grams)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.view(np.int64)),
                        pa.array(name.view(np.int64)),
                        pa.array(doc[owner]),
                        pa.array(spot),
                        pa.array(copy),
                    ],
                    ["gram", "name", "doc", "spot", "here"],
                )

    ordered = texts.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))
    return ordered.mapInArrow(run, "gram long, name long, doc long, spot long, here boolean")


def named_windows(texts: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """The windows of the asked positions, each under its own name of 95 bits (``name`` and ``more``).

    A name of 64 bits would be shared by different windows of a corpus of 100 TB now and then.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = text_bytes(field(batch, "text"))
            spots = field(batch, "spots")
            counts = np.diff(spots.offsets.to_numpy())
            spot = spots.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), counts)
            many = (spot & 0xFFFF) + 1
            first = np.cumsum(many) - many
            start = np.repeat(_start(spot), many) + np.arange(int(many.sum())) - np.repeat(first, many)
            owner = np.repeat(owner, many)
            doc, tie = field(batch, "doc_id").to_numpy(), field(batch, "tie").to_numpy()
            for i in range(0, len(start), SLICE_BYTES):
                j = slice(i, i + SLICE_BYTES)
                # hash only the stretch that these windows need
                low = int((at[owner[j]] + start[j]).min())
                high = int((at[owner[j]] + start[j]).max()) + length
                name = Rolling(data[low:high])(at[owner[j]] + start[j] - low, length)
                more = Rolling(data[low:high], 1)(at[owner[j]] + start[j] - low, length) >> np.uint64(33)
                place = _spot(tie[owner[j]], start[j], 0)
                copy, own = _copies_here(name, doc[owner[j]], place)
                name = np.where(copy, own, name)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(name.view(np.int64)),
                        pa.array(more.astype(np.int32)),
                        pa.array(doc[owner[j]]),
                        pa.array(place),
                        pa.array(copy),
                    ],
                    ["name", "more", "doc", "spot", "here"],
                )

    joined = texts.join(asked, (texts["doc_id"] == asked["doc"]) & (texts["tie"] == asked["of"]))
    return joined.select("doc_id", "tie", "text", "spots").mapInArrow(
        run, "name long, more int, doc long, spot long, here boolean"
    )


def repeated_windows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc, tie and ``spots``: first start and number (less one) of neighbouring repeated windows."""
    of_gram = Window.partitionBy("gram")
    in_order = Window.partitionBy("gram", "name").orderBy("doc", "spot")
    rows = sampled(texts, length, gram).withColumns(
        {"n": F.count(F.lit(1)).over(of_gram), "low": F.min("name").over(of_gram), "high": F.max("name").over(of_gram)}
    )
    rows = rows.where("here or n > 1").withColumns(
        {"copy": F.col("here") | _after_another(in_order), "mixed": F.col("low") < F.col("high")}
    )
    met = stored(rows.where("copy or mixed").select("doc", "spot", "copy"), "met-suffixes")
    tie = F.shiftright("spot", 48)
    asked = stored(
        met.where("not copy").groupBy("doc", tie.alias("of")).agg(F.array_sort(F.collect_set("spot")).alias("spots")),
        "asked-suffixes",
    )
    of_name = Window.partitionBy("name", "more").orderBy("doc", "spot")
    windows = named_windows(texts, asked, length)
    single = windows.withColumn("copy", F.col("here") | _after_another(of_name)).where("copy")
    found = met.where("copy").select("doc", "spot").unionByName(stored(single.select("doc", "spot"), "repeated-windows"))
    return found.groupBy("doc", tie.alias("of")).agg(F.collect_set("spot").alias("spots"))


def _after_another(order):
    """Whether the neighbour before in the sorted group is another position.

    Rows that repeat a whole document have equal positions; they are one position.
    """
    return F.rank().over(order) > 1


def cut_texts(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """doc_id, tie, ``spans`` (removed runs, start and end in bytes) and ``kept`` (bytes) of the found texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = text_bytes(field(batch, "text"))
            spots = field(batch, "spots")
            spot = spots.flatten().to_numpy()
            base = np.repeat(at[:-1], np.diff(spots.offsets.to_numpy()))
            start = base + _start(spot)
            n = len(data) + 1
            edge = np.bincount(start, minlength=n) - np.bincount(start + (spot & 0xFFFF) + length, minlength=n)
            gone = np.cumsum(edge[:-1]) > 0
            before = np.concatenate([[False], gone[:-1]])
            before[at[:-1][at[:-1] < len(data)]] = False
            after = np.concatenate([gone[1:], [False]])
            after[at[1:] - 1] = False
            first, last = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
            runs = np.searchsorted(first, at)
            shift = np.repeat(at[:-1], np.diff(runs))
            spans = pa.StructArray.from_arrays([pa.array(first - shift), pa.array(last - shift)], ["start", "end"])
            left = np.concatenate([[0], np.cumsum(~gone)])[at]
            kept = data[~gone].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    field(batch, "doc_id"),
                    field(batch, "tie"),
                    pa.ListArray.from_arrays(pa.array(runs.astype(np.int32)), spans),
                    pa.array([kept[i:j] for i, j in zip(left.tolist(), left[1:].tolist())], pa.binary()),
                ],
                ["doc_id", "tie", "spans", "kept"],
            )

    joined = texts.join(found, (texts["doc_id"] == found["doc"]) & (texts["tie"] == found["of"]))
    schema = "doc_id long, tie long, spans array<struct<start:long,end:long>>, kept binary"
    return joined.select("doc_id", "tie", "text", "spots").mapInArrow(run, schema)


def suffix_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> tuple[DataFrame, DataFrame]:
    """The texts (doc_id, text, tie), and for those that lose bytes doc_id, tie, ``spans`` and ``kept``."""
    texts = _texts(docs, doc_id, text)
    found = stored(repeated_windows(texts, length, gram), "repeated-spots")
    return texts, cut_texts(texts, found, length)


def op3_suffix_dedup(spark, folder: str) -> DataFrame:
    texts, cut = suffix_dedup(spark.read.parquet(f"{folder}/documents.parquet"))
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    figures = cut.select(
        F.col("doc_id").alias("_doc"),
        F.col("tie").alias("_tie"),
        lost.alias("lost"),
        F.size("spans").cast("long").alias("runs"),
        F.sha2("kept", 256).alias("rest"),
    )
    figures = stored(figures.dropDuplicates(["_doc", "_tie"]), "cut-figures")
    whole = F.coalesce("text", F.lit(""))
    narrow = texts.select(
        "doc_id", "tie", F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("whole")
    )
    joined = narrow.join(figures, (F.col("doc_id") == F.col("_doc")) & (F.col("tie") == F.col("_tie")), "left")
    none = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("lost", none).alias("n_removed"),
        F.coalesce("runs", none).alias("n_spans"),
        F.coalesce("rest", "whole").alias("kept_sha256"),
    )


# For tables whose doc_id is a key: every window of every text, as hexadecimal digits.
SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, md5_number(substring(h, 2 * i + 1, {2 * LENGTH})) AS w
            FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - {LENGTH - 1})) AS i FROM d WHERE len(h) >= {2 * LENGTH})),
copies AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows)
           WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {LENGTH})) AS p FROM copies),
lost AS (SELECT doc_id, count(*) AS n, sum(CAST(p - before > 1 OR before IS NULL AS BIGINT)) AS runs
         FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id),
rest AS (SELECT doc_id, string_agg(substring(h, 2 * p + 1, 2), '' ORDER BY p) AS h
         FROM (SELECT doc_id, h, unnest(range(len(h) // 2)) AS p FROM d JOIN lost USING (doc_id))
         ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n, 0) AS n_removed,
  CAST(coalesce(runs, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN d.h ELSE coalesce(rest.h, '') END)) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN rest USING (doc_id)
"""
