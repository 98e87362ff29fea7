"""BPE encoding and decoding: speculate with greedy longest match, verify, merge exactly only what fails.

Texts are cut into pre-tokens. New pre-tokens of a slice are encoded together in numpy: every step takes
the longest vocabulary entry at each word's position. A proposal is the true encoding exactly if every
two neighbours are compatible, i.e. no merge would have joined them across their border before the merges
that made them; that is tested for all neighbours at once. Words with a border that fails are merged one
pair at a time.

A null text is empty and has no ids. Each row is encoded on its own (no shuffle); equal rows get equal
results, and other columns are ignored. An empty table gives an empty result; a very long text is a slice of its own.

Characters beyond Latin-1 are tried once per worker against the library's own pre-tokenizer; texts with one that it
classes otherwise are cut by the library, and encoded here all the same.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmill.llm.tokens import WHITE_SPACE, WordIds, byte_letters, id_lists, load_json
from billmill.llm.words import field, slices

VOCABULARY = "byte_bpe_50k.json"

# A pre-token group: text without white space and at most one blank before it, or a run of white space.
_GROUPS = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
# Fixed value: the published pre-token pattern of byte-level BPE.
_PRETOKENS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
_BEYOND_LATIN = re.compile(r"[^\x00-\xff]")
_CUT = "\uffff"  # before a pre-token that the library has cut; no character, so it is never found to agree
_NEVER = np.iinfo(np.int64).max
_TOGETHER = 40  # longer failing words are merged one by one: a round per byte would be slow for them


class Lookup:
    """A read-only table of 64-bit keys, asked for many keys at once; -1 where a key is absent."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], -1)


@cache
def _pre_tokenizer():
    from tokenizers.pre_tokenizers import ByteLevel

    return ByteLevel(add_prefix_space=False, use_regex=True)


def _library_pretokens(text: str) -> list[str]:
    return [text[start:end] for _, (start, end) in _pre_tokenizer().pre_tokenize_str(text)]


class ByteBPE:
    """A byte-level BPE vocabulary read from a tokenizers file."""

    def __init__(self, name: str = VOCABULARY) -> None:
        spec = load_json(name)
        model, steps = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or steps["type"] != "ByteLevel" or steps["add_prefix_space"] or not steps["use_regex"]:
            raise ValueError(f"{name}: not a byte-level vocabulary with the published pre-token pattern")
        letters = {letter: byte for byte, letter in byte_letters().items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.token = [b""] * size
        for text, i in model["vocab"].items():
            if text not in self.special:
                self.token[i] = bytes(letters[c] for c in text)
        for text, i in self.special.items():
            self.token[i] = text.encode()
        self._merges(model)
        self._trie()
        lengths = np.array([len(t) for t in self.token])
        self.token_bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self.token_lengths, self.token_starts = lengths, np.cumsum(lengths) - lengths
        self._split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.groups = WordIds(self._encode_groups)
        self.agreed: dict[str, bool] = {}

    def _merges(self, model: dict) -> None:
        vocab = model["vocab"]
        size = len(self.token)
        # when[i]: the merge that makes token i (single bytes exist from the start)
        self.when = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.joined = np.zeros(len(model["merges"]), np.int64)
        keys, ranks = [], []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            i, j, joined = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault((i, j), (rank, joined))
            self.joined[rank] = joined
            keys.append(i << 32 | j)
            ranks.append(rank)
            if self.when[joined] < 0:
                self.when[joined], self.left[joined], self.right[joined] = rank, i, j
        self.pair_rank = Lookup(np.array(keys, np.int64), np.array(ranks, np.int64))
        self.byte_id = {t[0]: i for i, t in enumerate(self.token) if len(t) == 1 and i not in self.special.values()}
        self.id_of_byte = np.array([self.byte_id.get(b, 0) for b in range(256)], np.int64)
        # Entries that their own bytes never end up as cannot be proposed.
        made = np.flatnonzero(self.when >= 0)
        fits = self.compatible(self.left[made], self.right[made], before=self.when[made])
        self.proposable = np.zeros(size, bool)
        self.proposable[list(self.byte_id.values())] = True
        self.proposable[made[fits]] = True

    def _trie(self) -> None:
        """All prefixes of the proposable entries as numbered nodes; edges are keyed by node and byte."""
        nodes: dict[bytes, int] = {b"": 0}
        edges, ends = [], {}
        for i in np.flatnonzero(self.proposable):
            entry = self.token[i]
            for n in range(1, len(entry) + 1):
                if entry[:n] not in nodes:
                    nodes[entry[:n]] = len(nodes)
                    edges.append((nodes[entry[: n - 1]] << 8 | entry[n - 1], nodes[entry[:n]]))
            ends[nodes[entry]] = int(i)
        keys, targets = np.array(edges, np.int64).T
        self.edge = Lookup(keys, targets)
        self.node_token = np.full(len(nodes), -1, np.int64)
        self.node_token[list(ends)] = list(ends.values())

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` stay two tokens side by side.

        Follows the tokens that touch the border back in time. Two of them that exist together must not
        merge before either goes into a larger one; of equal merges the left one comes first.
        ``before`` limits the question to the merges earlier than that one.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        fits = np.ones(len(a), bool)
        until_a = np.full(len(a), _NEVER) if before is None else before.copy()
        # with a limit, the merge of a and b itself is no violation
        until_b = np.full(len(a), _NEVER) if before is None else before - 1
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            rank = self.pair_rank(x << 32 | y)
            joined = (rank >= 0) & (rank < until_a[live]) & (rank <= until_b[live])
            fits[live[joined]] = False
            back_a = self.when[x] > self.when[y]
            base = (self.when[x] < 0) & (self.when[y] < 0)
            go = ~joined & ~base
            live, back_a, x, y = live[go], back_a[go], x[go], y[go]
            until_a[live[back_a]] = self.when[x[back_a]]
            a[live[back_a]] = self.right[x[back_a]]
            until_b[live[~back_a]] = self.when[y[~back_a]]
            b[live[~back_a]] = self.left[y[~back_a]]
        return fits

    def propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match for many words: tokens and the word of each, in order."""
        at, word = starts.copy(), np.arange(len(starts))
        words, tokens, steps = [], [], []
        step = 0
        while len(word):
            node, token, length = np.zeros(len(word), np.int64), np.full(len(word), -1), np.zeros(len(word), np.int64)
            live, offset = np.arange(len(word)), 0
            while len(live):
                place = at[live] + offset
                inside = place < ends[word[live]]
                live, place = live[inside], place[inside]
                target = self.edge(node[live] << 8 | data[place])
                found = target >= 0
                live, target = live[found], target[found]
                node[live] = target
                offset += 1
                entry = self.node_token[target]
                hit = entry >= 0
                token[live[hit]], length[live[hit]] = entry[hit], offset
            words.append(word)
            tokens.append(token)
            steps.append(np.full(len(word), step))
            step += 1
            at = at + length
            more = at < ends[word]
            at, word = at[more], word[more]
        word = np.concatenate(words) if words else np.zeros(0, np.int64)
        order = np.lexsort((np.concatenate(steps) if steps else word, word))
        return (np.concatenate(tokens) if tokens else word)[order], word[order]

    def merge_exactly(self, word: bytes) -> list[int]:
        """The definition: join the pair of the earliest merge, leftmost first, until none is left."""
        ids = [self.byte_id[byte] for byte in word]
        n = len(ids)
        after, before, merge = [*range(1, n), -1], [*range(-1, n - 1)], self.merge
        heap = [(*merge[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in merge]
        heap = [(rank, i, joined, pair) for rank, joined, i, pair in heap]
        heapq.heapify(heap)
        while heap:
            _, i, joined, pair = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = joined, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (ids[x], ids[y]) in merge:
                    rank, new = merge[ids[x], ids[y]]
                    heapq.heappush(heap, (rank, x, new, (ids[x], ids[y])))
        return [i for i in ids if i >= 0]

    def merge_together(self, data: np.ndarray, starts: np.ndarray, length: int) -> list[bytes]:
        """``merge_exactly`` for many words of one length: every round joins one pair of each word."""
        ids = self.id_of_byte[data[starts[:, None] + np.arange(length)]]
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        out: list[bytes] = [b""] * len(starts)
        row = np.arange(len(starts))
        while len(row):
            width = ids.shape[1]
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(row), np.int64)
            least = ranks[np.arange(len(row)), at] if width > 1 else np.full(len(row), _NEVER)
            done = least == _NEVER
            if done.any():
                packed = ids[done].astype("<u4").tobytes()
                for k, i in enumerate(row[done].tolist()):
                    out[i] = packed[4 * width * k : 4 * width * (k + 1)]
                ids, ranks, row, at, least = (x[~done] for x in (ids, ranks, row, at, least))
                if not len(row):
                    break
            n = np.arange(len(row))
            ids[n, at] = self.joined[least]
            keep = np.ones(ids.shape, bool)
            keep[n, at + 1] = False
            ids = ids[keep].reshape(len(row), width - 1)
            keep = np.ones(ranks.shape, bool)
            keep[n, at] = False
            ranks = ranks[keep].reshape(len(row), width - 2)
            for side in (at - 1, at):
                near = np.flatnonzero((side >= 0) & (side < width - 2))
                ranks[near, side[near]] = self._ranks(ids[near, side[near]], ids[near, side[near] + 1])
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self.pair_rank(a << 32 | b)
        return np.where(rank < 0, _NEVER, rank)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit numbers."""
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lengths)
        tokens, word = self.propose(data, ends - lengths, ends)
        border = np.flatnonzero(word[1:] == word[:-1])
        fails = np.zeros(len(words), bool)
        fails[word[border[~self.compatible(tokens[border], tokens[border + 1])]]] = True
        packed = tokens.astype("<u4").tobytes()
        last = 4 * np.searchsorted(word, np.arange(1, len(words) + 1))
        first = [0, *last[:-1].tolist()]
        out = [packed[i:j] for i, j in zip(first, last.tolist())]
        failed = np.flatnonzero(fails)
        for length in np.unique(lengths[failed]):
            group = failed[lengths[failed] == length]
            if length <= _TOGETHER:
                merged = self.merge_together(data, ends[group] - length, int(length))
            else:
                merged = [np.array(self.merge_exactly(words[i]), "<u4").tobytes() for i in group]
            for i, ids in zip(group.tolist(), merged):
                out[i] = ids
        return out

    def _encode_groups(self, groups: list[str]) -> list[bytes]:
        parts = [[g] if g in self.special else [g[1:]] if g[0] == _CUT else _PRETOKENS.findall(g) for g in groups]
        distinct = list({part for group in parts for part in group}.difference(self.special))
        ids = dict(zip(distinct, self.encode_words([part.encode() for part in distinct])))
        ids |= {text: np.array([i], "<u4").tobytes() for text, i in self.special.items()}
        return [ids[group[0]] if len(group) == 1 else b"".join([ids[part] for part in group]) for group in parts]

    def _cut(self, text: str) -> list[str]:
        if self._split is None or self._split.search(text) is None:
            return self._grouped(text)
        # a special token is a group of its own
        pieces = self._split.split(text)
        return [g for p in pieces if p for g in ([p] if p in self.special else self._grouped(p))]

    def _grouped(self, text: str) -> list[str]:
        if _BEYOND_LATIN.search(text) is None or self._all_agree(text):
            return _GROUPS.findall(text)
        return [_CUT + piece for piece in _library_pretokens(text)]

    def _all_agree(self, text: str) -> bool:
        for c in set(text):
            if c not in self.agreed:
                tried = f"{c} a{c}1{c}-{c} {c}{c}a '{c}s  {c}"
                ours = [part for group in _GROUPS.findall(tried) for part in _PRETOKENS.findall(group)]
                self.agreed[c] = unicodedata.category(c) != "Cn" and ours == _library_pretokens(tried)
            if not self.agreed[c]:
                return False
        return True

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts after each other, and the number of ids of each text."""
        return self.groups([self._cut(text) for text in texts])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        lengths = self.token_lengths[ids]
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) + np.repeat(self.token_starts[ids] - first, lengths)
        data = self.token_bytes[place].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[i:j] for i, j in zip(ends, ends[1:])]


@cache
def coder(name: str = VOCABULARY) -> ByteBPE:
    """One coder per Python worker."""
    return ByteBPE(name)


_TYPES = {
    "doc_id": "long",
    "n_tokens": "long",
    "ids_sha256": "string",
    "decoded_sha256": "string",
    "ids": "array<int>",
    "decoded": "string",
}


def _coded(docs: DataFrame, doc_id: str, text: str, vocabulary: str, wanted: list[str]) -> DataFrame:
    """Encode and decode every row in one Python step, returning the wanted columns of ``_TYPES``."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocabulary)
        for batch in slices(batches, "text"):
            ids, counts = bpe.encode_texts([t or "" for t in field(batch, "text").to_pylist()])
            decoded = [d.decode("utf-8", "replace") for d in bpe.decode(ids.astype(np.int64), counts)]
            ends = np.cumsum(counts).tolist()
            columns = {
                "doc_id": lambda: field(batch, "doc_id"),
                "n_tokens": lambda: pa.array(counts.astype(np.int64)),
                "ids_sha256": lambda: pa.array(
                    [hashlib.sha256(ids[e - n : e].astype("<u4").tobytes()).hexdigest() for n, e in zip(counts, ends)],
                    pa.string(),
                ),
                "decoded_sha256": lambda: pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                "ids": lambda: id_lists(ids, counts),
                "decoded": lambda: pa.array(decoded, pa.string()),
            }
            yield pa.RecordBatch.from_arrays([columns[name]() for name in wanted], wanted)

    return narrow.mapInArrow(run, ", ".join(f"{name} {_TYPES[name]}" for name in wanted))


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ``ids`` (array of int) and ``decoded`` for every row."""
    return _coded(docs, doc_id, text, vocabulary, ["doc_id", "ids", "decoded"])


def digests(docs: DataFrame, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """Number and SHA-256 of the ids, and SHA-256 of the text decoded from them; ``ids`` as well on demand."""
    wanted = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
    return _coded(docs, "doc_id", "text", vocabulary, wanted)


def op7_bpe(spark, folder: str) -> DataFrame:
    return digests(spark.read.parquet(f"{folder}/documents.parquet"))
