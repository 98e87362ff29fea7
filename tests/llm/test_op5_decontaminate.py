from __future__ import annotations

from oracle import same_rows

from billmill.llm.op5_decontaminate import SQL, decontaminate, op5_decontaminate



def test_short_items_ties_and_nulls(spark, folder):
    docs = [(1, "a b c d e f g h i j k l m n o p"), (1, "a b c d e f g h i j k l m n o p"), (1, "x y z"), (2, None)]
    docs += [(3, ""), (None, "A B c, d e f"), (None, "q"), (4, "x  Y z x y z 1 É2 b"), (5, "a b c d e f g " * 30)]
    items = [(0, "b c d e f g h i j k l m n"), (1, "x y z"), (10, "X y z x"), (2, None), (3, ""), (7, "é2"), (8, "x y z")]
    items += [(None, "c d e f g h"), (8, "g a b c d e f g a b c d e f g a")]
    path = folder(
        documents=spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, marks string"),
        benchmark=spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, words int"),
    )
    same_rows(spark, op5_decontaminate, SQL, path)


def test_every_shared_window_is_found(spark, folder):
    """A span of just 13 words, at every place of a document."""
    words = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([f"d{k}"] * k + words[k : k + 13] + ["end"])) for k in range(48)]
    path = folder(
        documents=spark.createDataFrame(rows, "doc_id long, text string"),
        benchmark=spark.createDataFrame([(1, " ".join(words))], "item_id long, text string"),
    )
    assert all(r.n_hit == 13 for r in op5_decontaminate(spark, path).collect())


def test_boundary_and_empty(spark, boundary):
    items = spark.createDataFrame([(1, "the the the")], "item_id long, text string")
    found = decontaminate(boundary, items).collect()
    assert len(found) == boundary.count()
    assert {r.doc_id for r in found if r.contaminated} == {5}
    assert decontaminate(boundary.limit(0), items).collect() == []
    assert not any(r.contaminated for r in decontaminate(boundary, items.limit(0)).collect())
