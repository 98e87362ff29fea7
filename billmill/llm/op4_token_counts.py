"""Token counts by a unigram model, with one forward computation per shared prefix.

Texts are cut into pre-tokens (a run without white space and the blank before it, or a run of other white
space). The distinct pre-tokens of a slice of texts form a trie. Level by level, the best score of every
node is the best over the vocabulary entries that end there, so pre-tokens with a common prefix share its
scores; their end nodes hold the token counts. The unigram probability of the entry of rank r is
proportional to 1 / (r + 1) (Zipf), as costs in whole ten-thousandths, so sums are exact; of equal costs the
segmentation with fewer tokens counts. The probabilities are given by the rank; none are fitted.

A null or empty text has no tokens. Each row is counted on its own (no shuffle); equal rows get equal
results, and other columns are ignored. An empty table gives an empty result; a very long text is a slice of its own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmill.llm.op7_bpe import Lookup
from billmill.llm.tokens import vocabulary_file
from billmill.llm.words import WHITE, Words, field, slices, span_hashes, text_bytes

VOCABULARY = "byte_bpe_50k.tiktoken"
_LONG = 300  # longer pre-tokens are computed alone: a level per byte would be slow for them
_NONE = np.iinfo(np.int64).max // 4


def entry_costs(entries: list[bytes]) -> np.ndarray:
    """-log probability of each entry (by rank) in ten-thousandths."""
    ranks = np.arange(1, len(entries) + 1)
    return np.rint(1e4 * (np.log(ranks) + np.log((1 / ranks).sum()))).astype(np.int64)


class Unigram:
    def __init__(self, name: str = VOCABULARY) -> None:
        with open(vocabulary_file(name), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.entries = sorted(ranks, key=ranks.get)
        self.costs = entry_costs(self.entries)
        # The entries read from their last byte: edges by node and byte.
        nodes: dict[bytes, int] = {b"": 0}
        self.edges: dict[int, int] = {}
        for entry in self.entries:
            back = entry[::-1]
            for n in range(1, len(back) + 1):
                if back[:n] not in nodes:
                    nodes[back[:n]] = len(nodes)
                    self.edges[nodes[back[: n - 1]] << 8 | back[n - 1]] = nodes[back[:n]]
        self.edge = Lookup(np.array([*self.edges], np.int64), np.array([*self.edges.values()], np.int64))
        self.node_cost = np.full(len(nodes), _NONE)
        for entry, cost in zip(self.entries, self.costs.tolist()):
            self.node_cost[nodes[entry[::-1]]] = cost

    def one(self, word: bytes) -> tuple[int, int]:
        """Cost and count of a single pre-token."""
        best = [(0, 0)]
        costs = self.node_cost
        for i in range(1, len(word) + 1):
            node, found, j = 0, (_NONE, 0), i
            while j and (node := self.edges.get(node << 8 | word[j - 1], -1)) >= 0:
                j -= 1
                if costs[node] < _NONE:
                    found = min(found, (best[j][0] + int(costs[node]), best[j][1] + 1))
            best.append(found)
        return best[-1]

    def many(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs and counts of distinct pre-tokens through their trie."""
        lengths = ends - starts
        cost, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        size = 1
        place = np.zeros(len(starts), np.int64)
        live = np.flatnonzero(lengths <= _LONG)
        for i in np.flatnonzero(lengths > _LONG).tolist():
            cost[i], count[i] = self.one(data[starts[i] : ends[i]].tobytes())
        # of all trie nodes so far: parent, byte, best cost and its count; node 0 is the root
        all_parent, all_byte = np.zeros(1, np.int64), np.zeros(1, np.uint8)
        all_best, all_tokens = np.zeros(1, np.int64), np.zeros(1, np.int64)
        depth = 0
        while len(live):
            keys = place[live] << 8 | data[starts[live] + depth]
            level, which = np.unique(keys, return_inverse=True)
            depth += 1
            fresh = np.arange(size, size + len(level))
            if size + len(level) > len(all_best):
                more = max(size, len(level))
                all_parent, all_byte, all_best, all_tokens = (
                    np.concatenate([x, np.zeros(more, x.dtype)]) for x in (all_parent, all_byte, all_best, all_tokens)
                )
            all_parent[fresh], all_byte[fresh] = level >> 8, level & 0xFF
            # walk back from each new node through the reversed entries
            low, few = np.full(len(level), _NONE), np.zeros(len(level), np.int64)
            at, node, going = fresh.copy(), np.zeros(len(level), np.int64), np.arange(len(level))
            while len(going):
                node = self.edge(node << 8 | all_byte[at])
                ok = node >= 0
                going, node, at = going[ok], node[ok], all_parent[at[ok]]
                entry = self.node_cost[node]
                total, n = all_best[at] + entry, all_tokens[at] + 1
                better = (entry < _NONE) & ((total < low[going]) | ((total == low[going]) & (n < few[going])))
                low[going[better]], few[going[better]] = total[better], n[better]
                up = at > 0
                going, node, at = going[up], node[up], at[up]
            all_best[fresh], all_tokens[fresh] = low, few
            size += len(level)
            place[live] = fresh[which]
            over = lengths[live] == depth
            done = live[over]
            cost[done], count[done] = all_best[place[done]], all_tokens[place[done]]
            live = live[~over]
        return cost, count


def pre_tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of all pre-tokens."""
    words = Words(data, at, WHITE)
    starts = words.starts.copy()
    before = np.maximum(starts - 1, 0)
    blank = (starts > at[words.text]) & (data[before] == 0x20)
    starts[blank] -= 1
    rest = ~words.inside
    rest[starts[blank]] = False
    # a rest run never touches a blank that belongs to a word from behind, so runs stay apart
    spaces = Words(data, at, None, rest)
    return (
        np.concatenate([starts, spaces.starts]),
        np.concatenate([words.ends, spaces.ends]),
        np.concatenate([words.text, spaces.text]),
    )


@cache
def _model(name: str) -> Unigram:
    return Unigram(name)


def token_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pretokens, n_tokens, cost (ten-thousandths of a nat)."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(vocabulary)
        for batch in slices(batches, "text"):
            data, at = text_bytes(field(batch, "text"))
            starts, ends, owner = pre_tokens(data, at)
            _, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            cost, count = model.many(data, starts[first], ends[first])
            n = len(at) - 1
            sums = [np.zeros(n, np.int64) for _ in range(3)]
            for total, values in zip(sums, (np.ones(len(owner), np.int64), count[which], cost[which])):
                np.add.at(total, owner, values)
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id"), *map(pa.array, sums)], ["doc_id", "n_pretokens", "n_tokens", "cost"]
            )

    return narrow.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, cost long")


def op4_token_counts(spark, folder: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{folder}/documents.parquet"))
