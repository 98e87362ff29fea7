from __future__ import annotations

import itertools
import random
import zlib

import pyarrow as pa

from billmill.llm import op6_toxicity as op6
from billmill.llm.op6_toxicity import Grammar, clause_figures, op6_toxicity, score_toxicity


def weight(text):
    batch = pa.RecordBatch.from_pydict({"text": pa.array([text])})
    return clause_figures(batch, Grammar.of())[0, 2]


def test_clauses_not_words():
    assert weight("You are an idiot.") > weight("What an idiot.") > 0
    assert weight("You are not an idiot.") == 0
    assert 0 < weight('They wrote "you idiot" there.') < weight("You idiot.")
    assert 0 < weight("She said you are an idiot.") < weight("You are an idiot.")
    assert weight("I will kill you.") > weight("The frost did kill two plants.")
    assert weight("Not here. You idiot!") == weight("You idiot!")
    assert weight(None) == weight("") == weight("a quiet day") == 0


def test_negation_and_report_in_four_languages():
    for direct, no, said in (
        ("You are an idiot.", "You are not an idiot.", "She said you are an idiot."),
        ("Du bist ein idiot.", "Du bist kein idiot.", "Er sagte, du bist ein idiot."),
        ("Tu es un idiot.", "Tu n'es pas un idiot.", "Elle a dit que tu es un idiot."),
        ("Tú eres un idiot.", "Tú no eres un idiot.", "Ella dijo que tú eres un idiot."),
    ):
        assert weight(direct) > weight(said) > 0 == weight(no), direct
        assert weight(direct) == weight("You are an idiot.") and weight(said) == weight("She said you are an idiot.")
    assert weight("Die Leute kaufen die Karten.") == 0


def one_by_one(tape):
    """The weight of a clause, each machine read by itself; ``tape`` holds (symbol or 0, weight, quoted) per word."""
    states = {name: [0] for name in op6.MACHINES}
    for name, machine in op6.MACHINES.items():
        for symbol, _, quoted in tape:
            states[name].append(int(machine.next[states[name][-1], symbol + op6.QUOTED * quoted]))
    total = sum(w * op6.factor(s, q, **{n: x[i] for n, x in states.items()}) for i, (s, w, q) in enumerate(tape))
    return total * (op6.AIMED if states["target"][-1] else 1.0)


def by_definition(tape):
    total = 0.0
    for i, (symbol, weight, quoted) in enumerate(tape):
        if symbol not in (op6.INSULT, op6.THREAT):
            continue
        near = [s for s, _, _ in tape[max(0, i - op6.HOLDS) : i]]
        before = [s for s, _, _ in tape[:i]]
        if symbol == op6.THREAT and op6.INTENT not in near and op6.TARGET not in before:
            weight *= op6.UNMEANT
        if op6.NEGATION in near:
            weight *= op6.NEGATED
        if op6.REPORT in before or quoted:
            weight *= op6.REPORTED
        total += weight
    return total * (op6.AIMED if any(s == op6.TARGET for s, _, _ in tape) else 1.0)


def test_the_composition_reads_as_its_parts_do():
    rng = random.Random(2)
    for _ in range(3000):
        tape = [(rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6]), float(rng.randint(1, 5)), rng.random() < 0.2) for _ in range(rng.randrange(14))]
        read = [(s, w, place, q) for place, (s, w, q) in enumerate(tape) if s]
        found = op6.clause_weight(*(list(x) for x in zip(*read))) if read else 0.0
        assert abs(found - one_by_one(tape)) < 1e-9 and abs(found - by_definition(tape)) < 1e-9


def test_the_sample_has_one_row_per_doc_id(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:3]
    docs = spark.createDataFrame([(ids[0], f"text {i}") for i in range(500)] + [(ids[1], None), (ids[2], "x"), (ids[2], "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, toxic int")
    assert sorted((r.doc_id, r.text) for r in op6.labelled_sample(docs, labels, 12_000).collect() if r.text) == [(ids[0], "text 0"), (ids[2], "x")]
    assert op6.labelled_sample(docs, labels, 2).count() == 2


def test_long_texts_are_read_whole(spark):
    long = "quiet words here " * 200_000 + "\nYou are an idiot."
    assert weight(long) == weight("You are an idiot.")


def test_held_out_labels(spark):
    found = op6_toxicity(spark, "/root/testdata/sf0.01").collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    out = [(r.predicted, label[r.doc_id]) for r in found if r.held_out and r.doc_id in label]
    assert sum(p == t for p, t in out) / len(out) > 0.9


def test_held_out_labels_are_never_read(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "IF(crc32(string(doc_id)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    scores = [sorted(tuple(r) for r in score_toxicity(docs, x).collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_boundary_and_empty(spark, boundary):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    assert score_toxicity(boundary, labels).count() == boundary.count()
    assert score_toxicity(boundary, labels.limit(0)).where("score is null").count() == 0
    assert score_toxicity(boundary.limit(0), labels).collect() == []


def test_words_and_stems_of_a_small_language_are_learned(spark):
    """10 toxic documents hold a rare word, 10 others words of one stem, against 600 with a frequent one."""
    kinds = ["alma {i} tontazo {j}", "alma {i} bribonz{c} {j}", "alma {i} pest {j}", "alma {i} dia {j}"]
    name = ["".join(pair) for pair in itertools.product("abcdefghij", repeat=2)]
    texts = [(kinds[0], 1)] * 10 + [(kinds[1], 1)] * 10 + [(kinds[2], 1)] * 600 + [(kinds[3], 0)] * 2_000
    ids = (i for i in range(10_000) if zlib.crc32(str(i).encode()) % 5)
    rows = [(next(ids), t.format(i=name[n % 97], j=name[n % 89], c=name[n % 10]), y) for n, (t, y) in enumerate(texts)]
    unread = [i for i in range(20_000, 21_000) if zlib.crc32(str(i).encode()) % 5 == 0][:4]
    new = ["sol tontazo luz", "sol bribonzudo luz", "sol pest luz", "sol dia luz"]
    docs = spark.createDataFrame([*[r[:2] for r in rows], *zip(unread, new)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in score_toxicity(docs, labels).collect() if r.held_out}
    assert [found[i] for i in unread] == [1, 1, 1, 0]
