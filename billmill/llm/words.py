"""Words and their hashes for many texts at once, in numpy on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are worked through in slices of about this many bytes, which bounds a task's memory (a single
# longer text is a slice of its own).
SLICE_BYTES = 1 << 20

_EVEN = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _EVEN)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(0xD6E8FEB86659FD93, 4096)


def _powers(n: int) -> np.ndarray:
    return _POWERS if n <= len(_POWERS) else powers(0xD6E8FEB86659FD93, n)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 offsets between them; null is empty."""
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``SLICE_BYTES`` of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, at = text_bytes(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(at, at[start] + SLICE_BYTES, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the bytes of each span. ``inside`` may mark the same bytes, if no spans touch."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    held = data[inside] if inside is not None else data[place + np.repeat(starts, lengths)]
    terms = _BYTE_VALUES[held] * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * _EVEN)


class Words:
    """The words of a slice of texts: ``starts`` and ``ends`` in ``data``, and each word's text."""

    def __init__(
        self, data: np.ndarray, at: np.ndarray, separator: np.ndarray | None, inside: np.ndarray | None = None
    ) -> None:
        self.data, self.at = data, at
        inside = ~separator[data] if inside is None else inside
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        filled = at[:-1][at[:-1] < at[1:]]
        before[filled] = False
        after[at[1:][at[:-1] < at[1:]] - 1] = False
        self.inside = inside
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        # firsts[i] : firsts[i + 1] are the words of text i
        self.firsts = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.firsts)
        self.text = np.repeat(np.arange(len(at) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self.data, self.starts, self.ends, self.inside)

    def code_points(self) -> np.ndarray:
        """Code points in each word."""
        if not len(self):
            return np.zeros(0, np.int64)
        heads = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return heads[self.ends] - heads[self.starts]


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbours; runs over the end of a text are the caller's to drop."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(powers(0xA24BAED4963EE407, size)):
        out += hashes[j : j + n] * factor
    return mix(out + np.uint64(size * int(_EVEN) & 0xFFFFFFFFFFFFFFFF))


def by_text(firsts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one per word) per text."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[firsts[1:]] - total[firsts[:-1]]


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
