from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from billmill.llm import op1_jaccard_join as op1
from billmill.llm.components import connected_components
from billmill.llm.op1_jaccard_join import jaccard_join


def brute(rows, size=5, percent=80):
    """Components over all pairs of rows."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        whole = {tuple(words)} if words else set()
        sets.append({tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or whole)
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, tokens in enumerate(sets):
        for t in tokens:
            holders[t].append(k)
    for k, tokens in enumerate(sets):
        common = Counter(j for t in tokens for j in holders[t] if j > k)
        for j, n in common.items():
            both = rows[k][0], rows[j][0]
            if None not in both and 100 * n >= percent * (len(tokens) + len(sets[j]) - n):
                low, high = sorted(map(find, both))
                parent[high] = low
    return sorted(((i, len(t), None if i is None else find(i)) for (i, _), t in zip(rows, sets)), key=str)


def planted(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = [(None, "a b c"), (1, "a B c"), (2, "a b c"), (3, None), (4, ""), (5, " \n"), (6, "x"), (1, "a b c")]
    rows += [(2, "other text of the same id"), (9, "other text of the same id")]
    for group in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([6, 12, 30, 60, 150]))]
        if group % 3 == 0:  # a passage that many texts share, in all proportions
            words = [f"hot{k}" for k in range(80)] + words[: rng.randint(5, 25)]
        for _ in range(rng.choice([1, 2, 5, 20])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.4:  # chains: the next copies start from this one
                words = copy
            rows.append((100 + len(rows), " ".join(copy)))
    return rows


def test_planted_groups_chains_and_hot_passages(spark):
    rows = planted(5)
    df = spark.createDataFrame([(a, b, 7) for a, b in rows], "doc_id long, text string, rep int").repartition(5)
    assert sorted((tuple(r) for r in jaccard_join(df).collect()), key=str) == brute(rows)


def test_boundary_and_empty(spark, boundary):
    rows = [(r.doc_id, r.text) for r in boundary.collect()]
    assert sorted((tuple(r) for r in jaccard_join(boundary).collect()), key=str) == brute(rows)
    assert jaccard_join(boundary.limit(0)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (60, 40)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    expected = {i: 1 for i in [*range(1, 41), 60]} | {100 + i: 100 for i in range(50)}
    assert {r.node: r.component for r in found.collect()} == expected


def test_sets_of_one_doc_id_ask_with_their_own_size(spark):
    """doc 1 has a small set and a large one; the large one is similar to doc 2 only as a whole."""
    words = [f"w{i}" for i in range(104)]
    rows = [(1, "a b c d e f g"), (1, " ".join(words)), (2, " ".join([*words[:90], "x"])), (3, "a b c d e f g h i j k l"), (4, " ".join(words[:60]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(df).collect()), key=str)
    assert found == brute(rows)


def test_one_bucket_with_a_third_of_all_members(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[:59], f"v{i}"])) for i in range(60)] + [(100 + i, f"quite another text number {i} with words {i * 7}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(df).collect()), key=str)
    assert found == brute(rows)
    monkeypatch.setattr(op1, "HOT_SHARE", 2)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(df).collect()), key=str) == found
