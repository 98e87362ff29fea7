from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from billmill.llm.op7_bpe import VOCABULARY, coder, digests, op7_bpe
from billmill.llm.tokens import vocabulary_file


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_file(VOCABULARY))


def odd_texts():
    rng = random.Random(1)
    letters = "ab 's'll\n\t\r\x1c\x85\xa0 é日本😀١²'tTHE  the<|endoftext|>\x00aaa"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    return [*texts, "<|endoftext|>", "a <|endoftext|> b  <|endoftext|>", "a" * 5000, " " * 3000, "ab" * 3000, ""]


def test_equals_the_library(library):
    texts = odd_texts()
    ids, counts = coder().encode_texts(texts)
    ends = np.cumsum(counts)
    for text, n, end, back in zip(texts, counts, ends, coder().decode(ids.astype(np.int64), counts)):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids[end - n : end].tolist() == wanted
        assert back.decode("utf-8", "replace") == library.decode(wanted, skip_special_tokens=False)


def test_compatible_pairs_are_those_that_stay_apart():
    bpe, rng = coder(), np.random.default_rng(0)
    a, b = rng.choice(np.flatnonzero(bpe.proposable), (2, 3000))
    fits = bpe.compatible(a, b)
    for x, y, fit in zip(a.tolist(), b.tolist(), fits):
        assert fit == (bpe.merge_exactly(bpe.token[x] + bpe.token[y]) == [x, y])


def test_forgetting_changes_nothing():
    from billmill.llm.tokens import WordIds

    bpe = coder()
    texts = odd_texts()[:300]
    small = WordIds(bpe._encode_groups, size=10)
    for text in texts:
        ids, _ = small([bpe._cut(text)])
        assert ids.tolist() == bpe.encode_texts([text])[0].tolist()


def test_whole_table(spark, small, library):
    found = {r.doc_id: r for r in op7_bpe(spark, small).collect()}
    for row in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        r = found[row.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_boundary_and_empty(spark, boundary):
    assert digests(boundary).count() == boundary.count()
    assert digests(boundary.where("text is null")).first().n_tokens == 0
    assert digests(boundary.limit(0)).collect() == []


def test_every_character_is_cut_as_the_library_does_it():
    import random

    import numpy as np
    from test_op8_packed_ids import code_points
    from tokenizers import Tokenizer

    from billmill.llm import op7_bpe as op7
    from billmill.llm.tokens import vocabulary_file

    library = Tokenizer.from_file(vocabulary_file(op7.VOCABULARY))
    library.no_truncation()
    texts = [t for c in map(chr, code_points(97)) for t in (c, f"a{c}1{c}-{c} {c}b")] + ["-\U00012479", "\u058b", "\uffffx"]
    rng = random.Random(6)
    pool = [chr(c) for c in code_points(997)]
    texts += ["".join(rng.choice([rng.choice(pool), rng.choice("ab1 -'s\t")]) for _ in range(rng.randrange(30))) for _ in range(20_000)]
    ids, counts = op7.ByteBPE().encode_texts(texts)
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, part, w in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), want) if part.tolist() != w.ids] == []


def test_other_patterns_are_refused():
    import pytest

    from billmill.llm.op7_bpe import ByteBPE

    with pytest.raises(ValueError, match="pre-token pattern"):
        ByteBPE("word_bpe_49k.json")
