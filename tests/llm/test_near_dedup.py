import random

import numpy as np

from postings.llm.common import components
from postings.llm.near_dedup import circulant_signature, near_duplicates, shingle_set

SCHEMA = "doc_id long, text string, component_id string, kept string"


def brute(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(d, []).append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = {d: d for d in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(parent)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}


def corpus(seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows, base = [], [rnd.choice(words) for _ in range(120)]
    for i in range(60):  # a chain of edits: far ends differ, neighbours are near
        if i % 2:
            base[rnd.randrange(120)] = rnd.choice(words)
        rows.append(" ".join(base))
    for _ in range(60):
        rows.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60))))
    rows += rows[:20] + ["", None, "One", "one", "ONE two", "É one", "a  b\tc\nd\x0be\x0cf\rg"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_matches_all_pairs(spark):
    rows = corpus()
    for k in (2, 5):
        got = near_duplicates(spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA), k=k, percent=80).collect()
        want = brute(rows, k, 80)
        assert len(got) == len(rows)
        for r in got:
            assert r.component_id == want[r.doc_id], (k, r)
            assert r.kept == (r.doc_id == r.component_id)
            assert r.n_shingles == len({tuple(w) for w in [()] if False} | set(shingle_set((dict(rows)[r.doc_id] or "").encode(), k).tolist()))


def test_nulls_repeats_and_empty(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None), (3, None), (4, ""), (4, "x y z")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (4, 4, True)]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_document_of_two_texts_joins_both_groups(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "p q r s"), (3, "p q r s")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1)}


def test_partitioning_does_not_matter(spark):
    df = spark.createDataFrame(corpus(9), "doc_id long, text string")
    first = sorted(map(tuple, near_duplicates(df.repartition(1), k=2).collect()))
    assert first == sorted(map(tuple, near_duplicates(df.repartition(7), k=2).collect()))


def test_components_of_random_graphs(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    parent = list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    for n in {x for e in edges for x in e}:
        assert got.get(n, n) == root(n)


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(2)
    both, a, b = (rnd.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    x, y = (circulant_signature(np.concatenate([both, z]), 2048) for z in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.04
