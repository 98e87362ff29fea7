from __future__ import annotations

import corpus_pipeline
from billmill.llm.queries import QUERIES


def run_stages(spark, docs, sf_dir, tmp_path):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        place = str(tmp_path / f"stage-{name}")
        stage(spark, out[-1], sf_dir).write.parquet(place)
        out.append(spark.read.parquet(place))
    return out


def test_each_stage_decides(spark, small, tmp_path):
    filler = " ".join(f"word{i}" for i in range(60))
    item = spark.read.parquet(f"{small}/benchmark.parquet").first().text
    rows = [
        (1, f"{filler} clean", "en", "a", 1),
        (2, f"{filler} clean", "en", "b", 1),
        (3, f"{filler} clean indeed", "en", "c", 1),
        (4, "You are an idiot, a pathetic loser and a worthless moron. You stupid clown!", "en", "a", 1),
        (5, item, "en", "a", 1),
        (6, "my token = abcdef123456 is here", "en", "a", 31),
        (7, None, None, None, None),
        (8, "", "en", "a", 0),
        (None, "no id", "en", "a", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    raw, clean, single, apart, redacted, encoded = run_stages(spark, docs, small, tmp_path)

    def ids(df):
        return {r.doc_id for r in df.collect()}

    assert ids(clean) == {1, 2, 3, 5, 6, 7, 8, None}
    assert ids(single) == {1, 5, 6, 7, 8, None}
    assert ids(apart) == ids(redacted) == ids(encoded) == {1, 6, 7, 8, None}
    assert all(df.columns == docs.columns for df in (clean, single, apart, redacted))
    changed = redacted.where("doc_id = 6").first()
    assert changed.text == "my [SECRET] is here" and changed.n_chars == len(changed.text)
    assert redacted.where("doc_id = 1").first().n_chars == 1
    assert encoded.where("doc_id = 8").first().ids == []


def test_rows_of_one_doc_id_are_judged_by_their_texts(spark, small):
    words = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcd"]
    rows = [(1, words[0]), (1, words[1]), (1, None), (1, ""), (2, words[0] + " end"), (3, words[2]), (3, words[2]), (3, words[2] + " z"), (5, words[3])]
    rows += [(None, words[3]), (None, words[3]), (0, words[3] + " more")]
    df = spark.createDataFrame([(i, t, "en", "a", 9) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, df, small)
    assert kept.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    three = [text for doc, text in found if doc == 3]
    assert len(three) == 1 and three[0] in (words[2], words[2] + " z")
    want = [(0, words[3] + " more"), (1, words[1]), (1, ""), (1, None), (2, words[0] + " end"), (3, three[0]), (None, words[3]), (None, words[3])]
    assert found == sorted(want, key=str)


def test_empty_table(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    assert run_stages(spark, docs, small, tmp_path)[-1].count() == 0


def test_run_and_registry(spark, small):
    found = corpus_pipeline.run(spark, small)
    assert {"doc_id", "ids"} <= set(found.columns)
    assert 0 < found.count() < 200
    assert {int(name.split("_")[0][2:]) for name in QUERIES} == set(range(1, 14))
