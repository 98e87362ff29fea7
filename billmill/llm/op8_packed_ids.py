"""Token ids as binary files: fixed-width bit packing with block offsets.

``packed_ids`` is a Spark data source. A write task streams the ids of its documents into one file: blocks
of ids in the fewest bits that hold the vocabulary, then an index (document ids, their first ids, block
offsets) and a fixed-size tail. File names carry the attempt, and only committed files enter the
manifest, so a lost or repeated task leaves no trace. The manifest, one line per file, also holds each
file's first document and first id; a reader task opens one file and unpacks only the blocks it needs.

Rows of equal doc_id are ordered by the first characters of their texts, then by a hash of the text; rows without
doc_id come first. They may lie in several files, so one doc_id (or none) on a third of all rows is no hot task. A
null text is empty: it gets the end id only. An empty table gives an empty manifest and no rows. A very long text is
encoded alone, its ids are packed block by block. Other columns are ignored.

Words are cut out of texts with patterns of this module only where they are known to agree with the tokenizer: the
vocabulary file must state the pattern, and every character beyond Latin letters is tried once per worker, alone and
beside others, against the library. Any other text goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from billmill.llm.tokens import WHITE_SPACE, WordIds, load_json, vocabulary_file
from billmill.llm.words import field, slices
from billmill.workspace import new_folder

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK_IDS = 1 << 16
_MAGIC = b"PKID0001"
# bits, ids per block, documents, ids, blocks, place of the index
_TAIL = struct.Struct("<IIQQQQ8s")
_NO_ID = np.iinfo(np.int64).min


# --- Bit packing ---------------------------------------------------------------------------------


def bits_for(vocabulary_size: int) -> int:
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits per id, lowest bits first. Eight ids fill exactly ``bits`` bytes."""
    padded = np.zeros(-(-len(ids) // 8) * 8, np.uint64)
    padded[: len(ids)] = ids
    lanes = padded.reshape(-1, 8)
    out = np.zeros((len(lanes), bits), np.uint8)
    for j in range(8):
        low = j * bits
        for byte in range(low // 8, (low + bits - 1) // 8 + 1):
            shift = 8 * byte - low
            part = lanes[:, j] >> np.uint64(shift) if shift >= 0 else lanes[:, j] << np.uint64(-shift)
            out[:, byte] |= part.astype(np.uint8)
    return out.tobytes()


def unpack(packed: bytes, bits: int, count: int) -> np.ndarray:
    lanes = np.frombuffer(packed, np.uint8).reshape(-1, bits)
    out = np.zeros((len(lanes), 8), np.uint64)
    for j in range(8):
        low = j * bits
        for byte in range(low // 8, (low + bits - 1) // 8 + 1):
            shift = 8 * byte - low
            part = lanes[:, byte].astype(np.uint64)
            out[:, j] |= part << np.uint64(shift) if shift >= 0 else part >> np.uint64(-shift)
    return (out.reshape(-1)[:count] & np.uint64((1 << bits) - 1)).astype(np.uint32)


class PackedWriter:
    """Streams documents into an open file; holds one block of ids and the index of the file."""

    def __init__(self, out, bits: int) -> None:
        self.out, self.bits = out, bits
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.place = 0
        self.docs: list[np.ndarray] = []
        self.firsts: list[np.ndarray] = []
        self.blocks: list[int] = []

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.firsts.append(self.n_ids + np.cumsum(counts) - counts)
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // BLOCK_IDS * BLOCK_IDS
            for i in range(0, whole, BLOCK_IDS):
                self._block(ids[i : i + BLOCK_IDS])
            self.waiting, self.n_waiting = [ids[whole:].copy()], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        self.blocks.append(self.place)
        packed = pack(ids, self.bits)
        self.out.write(packed)
        self.place += len(packed)

    def close(self) -> dict:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        docs = np.concatenate([*self.docs, np.zeros(0, np.int64)]).astype("<i8")
        firsts = np.concatenate([*self.firsts, [self.n_ids]]).astype("<u8")
        self.out.write(docs.tobytes() + firsts.tobytes() + np.array([*self.blocks, self.place], "<u8").tobytes())
        self.out.write(
            _TAIL.pack(self.bits, BLOCK_IDS, len(docs), self.n_ids, len(self.blocks), self.place, _MAGIC)
        )
        return {"docs": len(docs), "ids": self.n_ids}


class PackedFile:
    """Random access to one file: ``ids(i, j)`` reads and unpacks only the blocks that hold ids i to j."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        tail = file.read_at(_TAIL.size, size - _TAIL.size)
        self.bits, self.block, n_docs, self.n_ids, n_blocks, place, magic = _TAIL.unpack(tail)
        if magic != _MAGIC:
            raise ValueError("not a file of packed ids")
        index = file.read_at(8 * (2 * n_docs + 2 + n_blocks), place)
        self.doc_ids = np.frombuffer(index, "<i8", n_docs)
        self.firsts = np.frombuffer(index, "<u8", n_docs + 1, 8 * n_docs).astype(np.int64)
        self.blocks = np.frombuffer(index, "<u8", n_blocks + 1, 8 * (2 * n_docs + 1)).astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, (last - 1) // self.block + 1
        packed = self.file.read_at(int(self.blocks[b] - self.blocks[a]), int(self.blocks[a]))
        ids = unpack(packed, self.bits, min(b * self.block, self.n_ids) - a * self.block)
        return ids[first - a * self.block : last - a * self.block]


# --- Data source ---------------------------------------------------------------------------------


def _store(path: str) -> tuple[fs.FileSystem, str]:
    # Hadoop's names for the same store; hdfs:// needs libhdfs on the workers.
    path = re.sub("^s3[an]://", "s3://", path)
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class _File(WriterCommitMessage):
    task: int
    name: str
    docs: int
    ids: int


@dataclass
class _Shard(InputPartition):
    path: str
    start: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, vocabulary: str, end_id: int | None) -> None:
        self.path, self.vocabulary, self.end_id = path.rstrip("/"), vocabulary, end_id
        self.bits = bits_for(_tokenizer(vocabulary).get_vocab_size())

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        task = TaskContext.get().partitionId()
        name = f"part-{task:08d}-{uuid.uuid4().hex}.ids"
        with store.open_output_stream(f"{folder}/{name}") as out:
            writer = PackedWriter(out, self.bits)
            encode = _cached(self.vocabulary)
            for batch in slices(iterator, "text"):
                ids, counts = closed(*encode([t or "" for t in field(batch, "text").to_pylist()]), self.end_id)
                doc_ids = field(batch, "doc_id").fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False)
                writer.add(doc_ids, counts, ids)
            figures = writer.close()
        return _File(task, name, **figures)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """One short message per task comes here; files of failed attempts are in no manifest."""
        store, folder = _store(self.path)
        files, start = [], 0
        for m in sorted((m for m in messages if m), key=lambda m: m.task):
            if m.docs:
                files.append({"name": m.name, "docs": m.docs, "ids": m.ids, "start": start})
                start += m.ids
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/manifest.json") as out:
            out.write(json.dumps({"bits": self.bits, "ids": start, "files": files}).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files without a manifest are no data."""


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def partitions(self) -> list[InputPartition]:
        store, folder = _store(self.path)
        with store.open_input_file(f"{folder}/manifest.json") as file:
            manifest = json.loads(file.read())
        return [_Shard(f"{self.path}/{f['name']}", f["start"]) for f in manifest["files"]] or [_Shard("", 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, place = _store(partition.path)
        with store.open_input_file(place) as file:
            packed = PackedFile(file)
            n = len(packed.doc_ids)
            i = 0
            while i < n:
                # whole documents of about eight blocks, one at least
                j = int(np.searchsorted(packed.firsts, packed.firsts[i] + 8 * packed.block, side="right")) - 1
                j = min(max(j, i + 1), n)
                values = packed.ids(int(packed.firsts[i]), int(packed.firsts[j]))
                offsets = (packed.firsts[i : j + 1] - packed.firsts[i]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))
                doc_ids = packed.doc_ids[i:j]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, mask=doc_ids == _NO_ID),
                        pa.array(packed.firsts[i:j] + partition.start),
                        ids,
                    ],
                    ["doc_id", "start", "ids"],
                )
                i = j


class PackedIds(DataSource):
    """``packed_ids``: option ``path``; for writing doc_id and text also ``vocabulary`` and ``end_id``."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return "doc_id long, start long, ids array<int>"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        end_id = self.options.get("end_id")
        return _Writer(self.options["path"], self.options["vocabulary"], None if end_id is None else int(end_id))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


# --- Encoding ------------------------------------------------------------------------------------


@cache
def _tokenizer(vocabulary: str):
    # Spark runs one worker per core: the library's own threads would only wait for each other.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_file(vocabulary))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# The normalizer and the words of the vocabulary file, as it states them.
_STATED_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_STATED_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The same words in lower-case text.
_ASCII_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^{WHITE_SPACE}a-z0-9]+")
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE_SPACE}\p{{L}}\p{{N}}]+")
# The same for texts whose only other characters are these letters: much faster.
_LATIN = "\u00df-\u00f6\u00f8-\u00ff"
_LATIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^{WHITE_SPACE}a-z0-9{_LATIN}]+")
_LATIN_CAPITALS = "\u00c0-\u00d6\u00d8-\u00de"
_BEYOND_LATIN = re.compile(rf"[^\x00-\x7f{_LATIN}{_LATIN_CAPITALS}]")
_TOGETHER = 400  # words per call of the library
# Marks of different combining classes: a character that sorts among them otherwise shows itself.
_MARKS = "\u0334\u3099\u094d\u05b0\u0327\u0323\u0301\u0345"


def states_our_words(vocabulary: dict) -> bool:
    """Whether the vocabulary file states the normalizer and pattern that this module cuts words by."""
    normalizers = (vocabulary.get("normalizer") or {}).get("normalizers")
    steps = (vocabulary.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = {"type": "Split", "pattern": {"Regex": _STATED_WORDS}, "behavior": "Removed", "invert": True}
    rest = [step.get("type") == "ByteLevel" and not step["add_prefix_space"] and not step["use_regex"] for step in steps[1:]]
    model = vocabulary["model"]
    ends = bool(model.get("end_of_word_suffix")) and not model.get("dropout") and not model.get("unk_token")
    return normalizers == _STATED_NORMALIZERS and steps[0] == split and rest == [True] and ends


@cache
def _composed() -> dict[str, list[str]]:
    """For each character the pairs of characters that compose with it to one."""
    found: dict[str, list[str]] = {}
    for code in range(0x80, 0x30000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            pair = "".join(chr(int(part, 16)) for part in parts)
            for character in set(pair):
                found.setdefault(character, []).append(pair)
    return found


class CachedTokenizer:
    """The library's ids of whole texts, computed once per word.

    Texts with special tokens, with the letter whose lower case depends on its place, or with a character that has
    not been found to agree go to the library as they are, and so do all texts of a vocabulary file that states other
    words.
    """

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = _tokenizer(vocabulary)
        self.ours = states_our_words(load_json(vocabulary))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = [*special, "\u03a3"]
        self.agreed: dict[str, bool] = {}
        vocab, suffix = self.tokenizer.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(1 + max(vocab.values()), bool)
        self.ends_word[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self.words = WordIds(self._words, 500_000)

    def _agrees(self, character: str) -> bool:
        """Whether the character is normalised, lowered and cut as the library does it, whatever stands beside it."""
        if unicodedata.category(character) == "Cn":
            return False
        c = character
        tried = [c, f"a{c}", f"{c}a", f"1{c}", f"{c}1", f"-{c}", f"{c}-", f"a{c}a", f"\u00e9{c}{c}", f"'{c}s"]
        tried += [f"x{c}{m} x{m}{c}" for m in _MARKS] + _composed().get(c, [])
        text = " ".join(tried)
        words = _WORDS.findall(unicodedata.normalize("NFC", text).lower())
        return b"".join(self._joined(words)) == self._whole(text)

    def _all_agree(self, text: str) -> bool:
        for character in set(text):
            if character not in self.agreed:
                self.agreed[character] = character.isascii() or self._agrees(character)
            if not self.agreed[character]:
                return False
        return True

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        # A text for the library alone is one word behind a blank; no other word has one.
        ids = iter(self._joined([w for w in words if w[0] != " "]))
        return [next(ids) if w[0] != " " else self._whole(w[1:]) for w in words]

    def _joined(self, words: list[str]) -> list[bytes]:
        groups = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        texts = [" ".join(group) for group in groups]
        out = []
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            last = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(last) == len(group) and last[-1] == 4 * len(ids):
                packed = ids.tobytes()
                out += [packed[i:j] for i, j in zip([0, *last[:-1]], last)]
            else:
                out += [self._whole(w) for w in group]
        return out

    def _cut(self, text: str) -> list[str]:
        if not self.ours or any(mark in text for mark in self.odd):
            return [" " + text]
        if text.isascii():
            return _ASCII_WORDS.findall(text.lower())
        normal = unicodedata.normalize("NFC", text).lower()
        if not _BEYOND_LATIN.search(text):
            return _LATIN_WORDS.findall(normal)
        return _WORDS.findall(normal) if self._all_agree(text) and self._all_agree(normal) else [" " + text]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts after each other, and the number of ids of each text."""
        return self.words([self._cut(text) for text in texts])


@cache
def _cached(vocabulary: str) -> CachedTokenizer:
    return CachedTokenizer(vocabulary)


def closed(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    if end_id is None:
        return ids, counts
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    own = np.ones(len(out), bool)
    own[np.cumsum(counts + 1) - 1] = False
    out[own] = ids
    return out, counts + 1


def write_packed(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int | None = END_ID,
) -> None:
    """Encode every text and write the ids in order of doc_id below ``path``: one range of rows per file."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # Ranges are found from samples of the order columns, so these are short; the last one splits equal rows.
    order = ["doc_id", F.substring("text", 1, 32), F.xxhash64("text"), F.monotonically_increasing_id()]
    order = [F.col("doc_id"), *[column.alias(f"_{i}") for i, column in enumerate(order[1:])]]
    placed = rows.select("doc_id", "text", *order[1:]).repartitionByRange("doc_id", "_0", "_1", "_2")
    ordered = placed.sortWithinPartitions("doc_id", "_0", "_1", "_2").select("doc_id", "text")
    docs.sparkSession.dataSource.register(PackedIds)
    writer = ordered.write.format("packed_ids").mode("append").option("vocabulary", vocabulary)
    if end_id is not None:
        writer = writer.option("end_id", end_id)
    writer.save(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids of every document below ``path``."""
    spark.dataSource.register(PackedIds)
    return spark.read.format("packed_ids").load(path)


def checksums(packed: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = field(batch, "ids")
            values = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            counts = np.diff(ids.offsets.to_numpy()).astype(np.int64)
            ends = np.cumsum(counts)
            crc = [zlib.crc32(values[e - n : e].tobytes()) for n, e in zip(counts, ends)]
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id"), field(batch, "start"), pa.array(counts), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return packed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_packed_ids(spark, folder: str) -> DataFrame:
    path = new_folder(spark, "packed-ids")
    write_packed(spark.read.parquet(f"{folder}/documents.parquet"), path)
    return checksums(read_packed(spark, path))
