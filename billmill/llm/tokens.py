"""Vocabulary files of public tokenizers, and words whose encoding is remembered."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

# White space as the tokenizers' patterns mean it (Unicode White_Space).
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"


def vocabulary_file(name: str) -> str:
    """The place of a public vocabulary file; BILLMILL_TOKENIZERS names another folder."""
    folder = os.environ.get("BILLMILL_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def load_json(name: str) -> dict:
    with open(vocabulary_file(name), encoding="utf-8") as file:
        return json.load(file)


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordIds:
    """The ids of words, computed once per word; forgets all words when it holds more than ``size``.

    ``compute`` gives the ids of new words as little-endian 32-bit numbers. Forgetting bounds the memory
    and costs time only.
    """

    def __init__(self, compute: Callable[[list[str]], list[bytes]], size: int = 250_000) -> None:
        self.compute, self.size = compute, size
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def __call__(self, cut: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (lists of words) after each other, and the number of ids of each text."""
        if len(self.numbers) > self.size:
            self._forget()
        number = self.numbers.__getitem__
        counts = np.array([len(words) for words in cut], np.int64)
        # Arrow finds the distinct words of the slice; only these are looked up.
        words = pa.array(list(chain.from_iterable(cut)), pa.string()).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False)
        which = np.fromiter(map(number, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        if self.numbers.new:
            packed = self.compute(self.numbers.new)
            self.sizes = np.concatenate([self.sizes, np.array([len(p) // 4 for p in packed], np.int64)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(packed), "<u4")])
            self.numbers.new = []
        starts = np.cumsum(self.sizes) - self.sizes
        sizes = self.sizes[which]
        first = np.cumsum(sizes) - sizes
        ids = self.ids[np.arange(int(sizes.sum())) + np.repeat(starts[which] - first, sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(ends)


def id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32)))
