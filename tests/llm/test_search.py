import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from postings.llm import search as s

SCHEMA = "doc_id long, text string, rank int, terms string, score long"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top):
    bags = [(d, terms(t)) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, length = len(bags), sum(len(b) for _, b in bags)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for i, q in wanted.items():
        found = []
        for d, b in bags:
            m = 100 - 50 + (50 * len(b) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * b.count(t)) // (1000 * b.count(t) + 20 * m)) for t in q if t in b)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(i, r, None if null else d, -x) for r, (x, null, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, n, words=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(0, 30)))) for i in range(n)]


def table(spark, docs, parts=3):
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in docs], SCHEMA).repartition(parts)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_ranks_equal_brute_force_with_small_shards_and_blocks(spark, monkeypatch):
    docs = corpus(1, 700)
    items = [(1, "w0 w1 w40 w59"), (2, "W3, w3; w50!"), (3, "w0"), (4, "nothing here"), (5, None), (None, "w7 w8 w20 w30 w31 w32"), (6, " ".join(f"w{i}" for i in range(60)))]
    got = s.search(table(spark, docs), items_of(spark, items), top=5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 5)
    monkeypatch.setattr(s, "BLOCK_TERMS", 10)  # several passes
    assert sorted(map(tuple, s.search(table(spark, docs), items_of(spark, items), top=5).collect()), key=str) == brute(docs, items, 5)


def test_nulls_ties_repeats_long_texts_and_empty_tables(spark):
    docs = [(7, "a b"), (7, "a b"), (3, "a b"), (None, "a b"), (None, None), (9, ""), (11, "!!! --"), (12, "É é ÉA ſ K"), (13, "zeta " * 30_000 + "a"), (14, "x1y_2z"), (15, "a" * 100_000)]
    items = [(1, "A"), (1, "b"), (2, "É K"), (3, "é"), (4, "2Z zeta"), (5, "a" * 100_000)]
    got = s.search(table(spark, docs), items_of(spark, items), top=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 3)
    assert s.search(table(spark, docs).limit(0), items_of(spark, items)).isEmpty()
    assert s.search(table(spark, docs), items_of(spark, items).limit(0)).isEmpty()


def test_blocks_round_trip_and_bound():
    rnd = np.random.default_rng(4)
    for most in (3, 300, 70_000, 5_000_000):
        docs, tf = np.unique(rnd.integers(0, most, 90)), rnd.integers(1, max(2, most // 40), 90)
        a, b = s.unpack(memoryview(s.pack(docs, tf[: len(docs)], -1)), -1)
        assert a.tolist() == docs.tolist() and b.tolist() == tf[: len(docs)].tolist()


def one_shard(docs, block):
    s_block, s.BLOCK = s.BLOCK, block
    ids, found, tf, sizes = s.TermIds(None), [], [], []
    for _, t in docs:
        ws = s.terms_of(t.encode())
        u, n = np.unique([ids[w] for w in ws], return_counts=True)
        found, tf, sizes = [*found, u], [*tf, n], [*sizes, len(ws)]
    row = s.shard_row([d for d, _ in docs], sizes, ids.names, np.concatenate(found), np.repeat(np.arange(len(docs)), [len(u) for u in found]), np.concatenate(tf))
    s.BLOCK = s_block
    return dict(zip([f.split()[0] for f in s.INDEX.split(", ")], row, strict=True))


def test_a_high_floor_leaves_blocks_packed_and_loses_nothing():
    docs = [(i, "common " * (1 + i % 5) + ("rare" if i in (700, 701) else f"w{i % 90}")) for i in range(1000)]
    row = one_shard(docs, 16)
    shard = s.Shard(row, 1000, sum(len(t.split()) for _, t in docs))
    best_of = lambda t: int(shard.block_maxima(shard.place[t]).max())
    names = ["common", "rare", "w3"]
    weights = np.array([1, 6000, 2000])
    item = s.Item(names, weights, np.array([w * best_of(t) for w, t in zip(weights, names, strict=True)]))
    every, scores = shard.search(item, 1, np.zeros(1000, np.int64))
    assert len(every) == 1000
    floor = int(np.sort(scores)[-2])
    fresh = s.Shard(row, *shard.totals)
    docs_, high = fresh.search(item, floor, np.zeros(1000, np.int64))
    assert sorted(zip(docs_.tolist(), high.tolist(), strict=True)) == sorted((d, x) for d, x in zip(every.tolist(), scores.tolist(), strict=True) if x >= floor)
    blocks_of_common = int(fresh.firsts[fresh.place["common"] + 1] - fresh.firsts[fresh.place["common"]])
    assert blocks_of_common == 63 and len(fresh.blocks) <= 3  # the rare list, and one block of the common one


def test_a_full_index_serves_any_items(spark):
    docs = corpus(5, 300)
    index = s.build_index(table(spark, docs))
    items = [(i, f"w{i} w{i + 7}") for i in range(20)]
    assert sorted(map(tuple, s.search(table(spark, docs), items_of(spark, items), top=4, index=index).collect()), key=str) == brute(docs, items, 4)
    assert index.agg(F.sum("n_docs")).first()[0] == sum(1 for _, t in docs if t)
