from __future__ import annotations

import json
import random
import zlib

import numpy as np
import pytest

from billmill.llm import op8_packed_ids as op8


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 9, 13, 16, 17, 24, 31, 32])
def test_packing_round_trip(bits):
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 2**bits, n, dtype=np.uint64).astype(np.uint32)
        packed = op8.pack(ids, bits)
        assert len(packed) == -(-n // 8) * bits
        assert (op8.unpack(packed, bits, n) == ids).all()


def test_random_access(tmp_path, monkeypatch):
    from pyarrow import fs

    monkeypatch.setattr(op8, "BLOCK_IDS", 64)
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 90, 50)
    ids = rng.integers(0, 49408, int(counts.sum())).astype(np.uint32)
    store = fs.LocalFileSystem()
    with store.open_output_stream(str(tmp_path / "x.ids")) as out:
        writer = op8.PackedWriter(out, 16)
        writer.add(np.arange(20), counts[:20], ids[: counts[:20].sum()])
        writer.add(np.arange(20, 50), counts[20:], ids[counts[:20].sum() :])
        writer.close()
    with store.open_input_file(str(tmp_path / "x.ids")) as file:
        packed = op8.PackedFile(file)
        assert packed.firsts.tolist() == [0, *np.cumsum(counts).tolist()]
        for i, j in [(0, 0), (0, 1), (5, 700), (63, 65), (64, 128), (0, len(ids))]:
            assert (packed.ids(i, j) == ids[i:j]).all()


def test_cached_encoding_equals_the_library():
    rng = random.Random(3)
    letters = "ab 's'll\n\t\r\x1c\x85\xa0 é日本😀١²'tTHEΣİ  the<|endoftext|>\x00aaá"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["<|endoftext|>", "a <|endoftext|> b"]
    encode = op8.CachedTokenizer(op8.VOCABULARY)
    ids, counts = encode(texts)
    for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert part.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def code_points(step):
    """Every code point of the first planes' scripts that differ between versions of Unicode, and every ``step``-th one."""
    return sorted({*range(0x0, 0x3400), *range(0xA000, 0xAC00), *range(0x10000, 0x13000), *(c for c in range(0, 0x110000, step))} - {*range(0xD800, 0xE000)})


def test_every_character_is_encoded_as_the_library_does_it():
    encode = op8.CachedTokenizer(op8.VOCABULARY)
    texts = [t for c in map(chr, code_points(97)) for t in (c, f"a{c}1{c}-{c} {c}b")] + ["-\U00012479", "\u058b"]
    rng = random.Random(5)
    pool = [chr(c) for c in code_points(997)]
    texts += ["".join(rng.choice([rng.choice(pool), rng.choice("ab1 -'s\t"), rng.choice("ÉßéÏx")]) for _ in range(rng.randrange(30))) for _ in range(20_000)]
    ids, counts = encode(texts)
    library = encode.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, part, want in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), library) if part.tolist() != want.ids] == []


def test_a_vocabulary_with_other_words_goes_to_the_library_whole():
    other = "byte_bpe_50k.json"
    encode = op8.CachedTokenizer(other)
    assert op8.CachedTokenizer(op8.VOCABULARY).ours and not encode.ours
    texts = ["Some text, it's 12  words\n", "", "été 日本", "x"]
    ids, counts = encode(texts)
    want = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_one_doc_id_on_all_rows_is_several_files(spark, tmp_path):
    rows = [(None, "the same text")] * 3000 + [(7, f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        op8.write_packed(df, str(tmp_path / "ids"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = json.loads((tmp_path / "ids" / "manifest.json").read_text())["files"]
    assert len(files) == 8 and max(f["docs"] for f in files) < 2000
    back = op8.read_packed(spark, str(tmp_path / "ids")).orderBy("start").collect()
    assert [r.doc_id for r in back] == [None] * 3000 + [7] * 3000


def expected(rows):
    library, start, out = op8._tokenizer(op8.VOCABULARY), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, op8.END_ID], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op8.op8_packed_ids(spark, small).collect()), key=str) == expected(rows)


def test_boundary_and_empty(spark, folder, boundary):
    rows = [(r.doc_id, r.text) for r in boundary.collect()]
    found = op8.op8_packed_ids(spark, folder(documents=boundary)).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(rows)


def test_empty_table(spark, folder, boundary):
    assert op8.op8_packed_ids(spark, folder(documents=boundary.limit(0))).collect() == []
