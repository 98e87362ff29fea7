"""Rows of CSV files whose quoted cells hold line breaks, without making a file one task.

A line begins inside or outside quotes, and ends so; what it makes of either beginning can be said without knowing
which one is true. (A quote opens a cell only as its first character, so counting quotes is not enough.)

1. Per block of a file: how the block ends after either beginning, and which line has opened the row that is open then.
2. A running composition over the blocks of a file, one short row per block, says which blocks begin inside quotes and
   in which earlier block that row was opened.
3. Each task walks through its lines from the true state: rows that begin and end in the same batch of lines go on whole,
   other lines carry the place of the line that opened their row.
4. Only these lines, at the edges of batches and blocks, are shuffled, and put together to rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billmill.workspace import stored

# A row of more lines has lost its closing quote; it would swallow the rest of its file.
MOST_LINES = 100_000

# A cell that ends in its line: quoted (doubled quotes inside, anything but a quote behind), plain, or empty.
_CLOSED = r'[^"]*(?:""[^"]*)*"(?:[^",][^,]*)?'
_CELL = rf'(?:"{_CLOSED}|[^",][^,]*|)'
# Lines that end outside quotes, begun outside and begun inside.
_OUTSIDE = rf"^{_CELL}(?:,{_CELL})*$"
_INSIDE = rf"^{_CLOSED}(?:,{_CELL})*$"


def ends_inside(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line ends inside quotes, begun outside and begun inside. Null stands for a line without quotes."""
    n = len(texts)
    from_outside, from_inside = np.zeros(n, bool), np.ones(n, bool)
    quoted = np.flatnonzero(pc.fill_null(pc.match_substring(texts, '"'), False).to_numpy(zero_copy_only=False))
    if len(quoted):
        held = texts.take(pa.array(quoted))
        from_outside[quoted] = ~pc.match_substring_regex(held, _OUTSIDE).to_numpy(zero_copy_only=False)
        from_inside[quoted] = ~pc.match_substring_regex(held, _INSIDE).to_numpy(zero_copy_only=False)
    return from_outside, from_inside


def states(from_outside: np.ndarray, from_inside: np.ndarray, start: bool) -> np.ndarray:
    """Whether the text is inside quotes after each line, begun with ``start``."""
    fixed = from_outside == from_inside
    turns = np.cumsum(from_outside & ~from_inside)
    at = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    base = np.where(at >= 0, from_outside[at], start)
    since = turns - np.where(at >= 0, turns[at], 0)
    return base ^ (since % 2 == 1)


class _Block:
    """Lines of one block in their order, read from one start state."""

    def __init__(self, start: bool) -> None:
        self.inside = start
        self.lines = self.opened = self.n_opened = 0  # opened: number of the line that opened the open row, from 1

    def read(self, from_outside: np.ndarray, from_inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inside before, inside after, and the opening line of the row that each line belongs to (0: opened earlier)."""
        after = states(from_outside, from_inside, self.inside)
        before = np.concatenate([[self.inside], after[:-1]])
        opens = ~before & after
        number = self.lines + np.arange(1, len(after) + 1)
        # A line that begins outside belongs to its own row, others to the last row that was opened.
        owner = np.maximum.accumulate(np.where(~before, number, self.opened))
        self.inside, self.lines, self.opened = bool(after[-1]), self.lines + len(after), int(owner[-1])
        self.n_opened += int(opens.sum())
        return before, after, owner


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """The stretches of a batch that lie in one block: (file, block), first row, row behind."""
    names = batch.column(batch.schema.get_field_index("file")).dictionary_encode()
    which = names.indices.to_numpy()
    blocks = batch.column(batch.schema.get_field_index("block")).to_numpy()
    edges = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (which[1:] != which[:-1]), [True]]))
    for low, high in zip(edges.tolist(), edges[1:].tolist()):
        yield (names.dictionary[int(which[low])].as_py(), int(blocks[low])), low, high


_ENDS = "file string, block long, ends boolean, ends_in boolean, opened long, opened_in long, n_opened long, n_opened_in long"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: how it ends, the line that opened the row that is open then (0: an earlier block), and the
    rows opened; begun outside and, behind, begun inside."""
    here, both = None, ()

    def said() -> pa.RecordBatch:
        columns = [[here[0]], [here[1]], *[[b.inside] for b in both]]
        columns += [[b.opened if b.inside else 0] for b in both] + [[b.n_opened] for b in both]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [part.split()[0] for part in _ENDS.split(", ")])

    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        for place, low, high in _runs(batch) if batch.num_rows else ():
            if place != here:
                if here is not None:
                    yield said()
                here, both = place, (_Block(False), _Block(True))
            lines = ends_inside(texts.slice(low, high - low))
            for block in both:
                block.read(*lines)
    if here is not None:
        yield said()


_LINES = "file string, block long, line long, is_header boolean, opened long, nth long, text string"


class _Walk:
    """A block read from its true state; the row open at its start was opened at line ``nth`` of block ``opened``."""

    def __init__(self, file: str, block: int, opened: int | None, nth: int | None) -> None:
        self.file, self.block = file, block
        self.opened, self.nth = (opened, nth) if opened is not None else (-1, -1)
        self.state = _Block(opened is not None)
        self.header = block > 0
        self.longest = 0  # lines of the row that is open now, as far as they lie in this block

    def lines_of(self, texts: pa.Array) -> pa.RecordBatch:
        n, first = len(texts), self.state.lines
        before, after, owner = self.state.read(*ends_inside(texts))
        whole = ~before & ~after
        opened = np.where(whole, -1, np.where(owner > 0, self.block, self.opened))
        nth = np.where(whole, -1, np.where(owner > 0, owner, self.nth))
        self._refuse_long(whole, nth)
        is_header = np.zeros(n, bool)
        if not self.header:
            filled = np.flatnonzero(pc.match_substring_regex(texts, r"\S").to_numpy(zero_copy_only=False))
            if len(filled):
                is_header[filled[0]] = self.header = True
        keep, texts = self._join_rows(before, after, opened, nth, texts)
        columns = [
            pa.repeat(pa.scalar(self.file, pa.string()), len(keep)), np.full(len(keep), self.block),
            first + keep, is_header[keep], opened[keep], nth[keep], texts,
        ]
        names = [part.split()[0] for part in _LINES.split(", ")]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    @staticmethod
    def _join_rows(before, after, opened, nth, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The lines to go on with and their texts: rows that begin and end among these lines are one line from here."""
        n, starts = len(texts), np.flatnonzero(~before)
        low = int(starts[0]) if len(starts) else n
        high = int(starts[-1]) if len(starts) and after[-1] else n
        rows = starts[starts < high]
        keep = np.concatenate([np.arange(low), rows, np.arange(high, n)])
        if len(keep) == n:
            return keep, texts
        opened[rows] = nth[rows] = -1
        offsets = pa.array(np.append(rows, high) - low, pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, texts.slice(low, high - low)), "\n")
        return keep, pa.concat_arrays([texts.slice(0, low), joined, texts.slice(high)])

    def _refuse_long(self, whole: np.ndarray, nth: np.ndarray) -> None:
        edges = np.flatnonzero(np.concatenate([[True], nth[1:] != nth[:-1], [True]]))
        for low, high in zip(edges.tolist(), edges[1:].tolist()):
            longest = 0 if whole[low] else high - low + (self.longest if low == 0 else 0)
            if longest > MOST_LINES:
                raise ValueError(f"a quote stays open over {longest} lines: {self.file}, block {self.block}")
        self.longest = longest


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, walk = None, None
    for batch in batches:
        opened, nth, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("opened", "nth", "text"))
        for place, low, high in _runs(batch) if batch.num_rows else ():
            if place != here:
                here, walk = place, _Walk(*place, opened[low].as_py(), nth[low].as_py())
            yield walk.lines_of(texts.slice(low, high - low))


class QuotedLines:
    """The lines of the files at ``path``, as rows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.lines = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text")
        )

    @cached_property
    def blocks(self) -> DataFrame:
        """file, block, inside (begins inside quotes), ended (the line that opened the row open at its end, 0 for none
        or an earlier block) and n_opened: one row per block, from its true beginning."""
        # Lines without quotes change nothing; only their number matters, so they travel as NULL.
        lines = self.lines.select("file", "block", F.when(F.contains("text", F.lit('"')), F.col("text")).alias("text"))
        ends = stored(lines.mapInArrow(_ends, _ENDS), "block-ends")
        order = Window.partitionBy("file").orderBy("block")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        turns = F.sum((F.col("ends") & ~F.col("ends_in")).cast("long")).over(order)
        fixed = F.when(F.col("ends") == F.col("ends_in"), F.struct(F.col("ends").alias("state"), F.col("turns").alias("turns")))
        last = F.last(fixed, ignorenulls=True)
        ends = ends.withColumn("turns", turns).withColumns({"last": last.over(before), "turned": F.lag("turns", 1, 0).over(order)})
        since = (F.col("turned") - F.coalesce(F.col("last.turns"), F.lit(0))) % 2 == 1
        inside = F.coalesce(F.col("last.state"), F.lit(False)) != since
        found = ends.withColumn("inside", inside)
        ended = F.when(F.col("inside"), F.col("opened_in")).otherwise(F.col("opened"))
        n_opened = F.when(F.col("inside"), F.col("n_opened_in")).otherwise(F.col("n_opened"))
        return stored(found.select("file", "block", "inside", ended.alias("ended"), n_opened.alias("n_opened")), "quote-states")

    def has_breaks(self) -> bool:
        return not self.blocks.where("n_opened > 0").isEmpty()

    def open_blocks(self) -> DataFrame:
        """file, block, opened, nth of the blocks that begin inside quotes: the block and line that opened the row."""
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        holder = F.when(F.col("ended") > 0, F.struct(F.col("block").alias("opened"), F.col("ended").alias("nth")))
        found = self.blocks.withColumn("holder", F.last(holder, ignorenulls=True).over(before))
        return stored(found.where("inside").select("file", "block", "holder.opened", "holder.nth"), "open-blocks")

    def rows(self) -> DataFrame:
        """file, block, line, is_header, text: one row per row of a file, blank ones left out, with the place of its
        first line."""
        # At most one row per block of the input, and only of those that begin inside quotes.
        lines = self.lines.join(F.broadcast(self.open_blocks()), ["file", "block"], "left")
        walked = lines.select("file", "block", "opened", "nth", "text").mapInArrow(_walk, _LINES)
        walked = stored(walked.where("nth >= 0 or trim(text) <> ''"), "csv-lines")
        columns = ["file", "block", "line", "is_header", "text"]
        single = walked.where("nth < 0").select(columns)
        lines = F.array_sort(F.collect_list(F.struct("block", "line", "is_header", "text"))).alias("lines")
        longer = walked.where("nth >= 0").groupBy("file", "opened", "nth").agg(lines)
        longer = longer.select(
            "file",
            F.col("lines")[0]["block"].alias("block"),
            F.col("lines")[0]["line"].alias("line"),
            F.col("lines")[0]["is_header"].alias("is_header"),
            F.array_join(F.col("lines.text"), "\n").alias("text"),
        )
        return single.unionByName(longer)
