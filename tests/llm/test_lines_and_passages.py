import math
import random

import numpy as np
from pyspark.sql import functions as F

from postings.llm import common, line_dedup
from postings.llm.common import classes
from postings.llm.line_dedup import DISTANCE, dedup_lines, normal, shared_buckets, simhashes
from postings.llm.passages import drop_repeats, super_kmers


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_lines(rows):
    places = {}
    for d, t in rows:
        for j, line in enumerate((t or "").split("\n")) if d is not None else ():
            if n := normal(line):
                places.setdefault(n, []).append((d, j))
    names = list(places)
    sims = simhashes(names).view(">u8").astype(np.uint64)
    parent = list(range(len(names)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(names)):
        for j in range(i):
            a, b = names[i].decode(), names[j].decode()
            if int(np.bitwise_count(sims[i] ^ sims[j]).sum()) <= DISTANCE and edits(a, b) <= math.floor(0.2 * max(len(a), len(b))):
                parent[root(i)] = root(j)
    first = {}
    for i, n in enumerate(names):
        first[root(i)] = min([first.get(root(i), min(places[n])), *places[n]])
    at = {n: root(i) for i, n in enumerate(names)}
    return [(d, "\n".join(x for j, x in enumerate((t or "").split("\n")) if d is None or not normal(x) or first[at[normal(x)]] == (d, j))) for d, t in rows]


def test_lines_match_all_pairs(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(200)]
    line = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    long = [line(60) for _ in range(12)]
    rows = []
    for d in range(40):
        out = [line(rnd.randint(1, 8)) for _ in range(3)] + [rnd.choice(long), "", "Common LINE, no. 7!", "common line no 8"]
        if d % 3 == 0:  # one word of sixty more: a few bits of the SimHash at most
            out.append(rnd.choice(long) + " " + rnd.choice(words))
        rnd.shuffle(out)
        rows.append((d, "\n".join(out)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "Common line, no 7")]
    got = dedup_lines(spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, line int")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.kept_text) for r in got) == sorted((-1 if d is None else d, t) for d, t in brute_lines(rows))
    by = {r.doc_id: r for r in got}
    assert by[100].n_lines == 0 and by[101].n_lines == 1 and by[102].n_lines == 3
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_lines_by_edit_similarity_alone(spark):
    """All pairs by edits only, no SimHash: lines with a typo, one word replaced, or one edit of a short line."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(3000)]
    rows, pairs = [], 0
    for n in (4, 10, 20, 40, 80):
        for i in range(20):
            line = [rnd.choice(words) for _ in range(n)]
            other, at = list(line), rnd.randrange(n)
            other[at] = rnd.choice(words) if i % 2 and n > 4 else other[at][:1] + "x" + other[at][2:]
            a, b = " ".join(line), " ".join(other)
            pairs += a != b and edits(a, b) <= 0.2 * max(len(a), len(b))
            rows += [(len(rows), a), (len(rows) + 1, b)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    removed = {r.doc_id for r in got if r.n_removed}
    assert all(d % 2 for d in removed) and pairs > 90
    assert len(removed) >= 0.97 * pairs, (len(removed), pairs)


def test_a_crowded_bucket_keeps_pairs_that_share_no_other(spark):
    """400 lines in one bucket, each with a bucket of its own and every other one in a bucket of two."""
    rows = [(1, i) for i in range(400)] + [(1000 + i, i) for i in range(400)] + [(5000 + i // 4, i) for i in range(400) if i % 4 < 2] + [(1, 7)]
    got = sorted(map(tuple, shared_buckets(spark.createDataFrame(rows, "key long, head long")).collect()))
    assert got == sorted({r for r in rows if not 1000 <= r[0] < 5000})


def test_classes_of_a_large_bucket_miss_no_link(spark):
    """1,500 members of one bucket (and some of a second): a large class, pairs with one link only, and members without any."""
    rnd = random.Random(6)
    links = {tuple(sorted(rnd.sample(range(700), 2))) for _ in range(3000)} | {(i, 2000 - i) for i in range(701, 1000)} | {(5, 1400)}
    node = lambda i: f"{i * 7919 % 10007:05d}"
    named = {tuple(sorted((node(a), node(b)))) for a, b in links}
    ids = sorted({i for p in links for i in p} | set(range(1300, 1500)))
    members = spark.createDataFrame([(1, node(i)) for i in ids] + [(2, node(i)) for i in ids if i % 3 == 0], "key long, node string")
    nodes = members.select("node").distinct().withColumn("n", F.lit(1))
    known = F.broadcast(spark.createDataFrame(sorted(named), "u string, v string"))
    confirm = lambda pairs: pairs.join(known, (F.least("a", "b") == F.col("u")) & (F.greatest("a", "b") == F.col("v"))).select("a", "b")
    parent = {node(i): node(i) for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in named:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found = classes(members, nodes, lambda x, y: F.col(f"{x}.n") == F.col(f"{y}.n"), confirm, deals=(8, 32))
    assert sorted(map(tuple, found.collect())) == sorted((x, root(x)) for x in parent if root(x) != x)


def brute_passages(rows, k):
    first = {}
    cut = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in cut:
        for i in range(len(w) - k + 1) if d is not None else ():
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in cut:
        gone = set()
        for i in range(len(w) - k + 1) if d is not None else ():
            if first[tuple(w[i : i + k])] < d:
                gone.update(range(i, i + k))
        out.append((-1 if d is None else d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out)


def test_passages_match_brute_force(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    passage = [rnd.choice(words) for _ in range(30)]
    rows = []
    for d in range(60):
        w = [rnd.choice(words) for _ in range(rnd.randint(0, 60))]
        if d % 2:
            at = rnd.randint(0, len(w))
            w[at:at] = passage[rnd.randint(0, 8) :]
        if d % 7 == 0:
            w = w + w
        rows.append((d, "  ".join(w)))
    rows += [(70, None), (71, ""), (72, rows[3][1]), (72, rows[3][1]), (72, rows[5][1]), (None, rows[1][1]), (73, " ".join(["same"] * 500)), (74, " ".join(["same"] * 400)), (75, "wörter mit " * 20)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, ranges string")
    for parts in (1, 5):
        got = drop_repeats(df.repartition(parts), k=13).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_passages(rows, 13)
    assert drop_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_super_kmers_cover_every_window_once():
    h = np.random.default_rng(3).integers(0, 50, 500).astype(np.uint64)
    least, first, n = super_kmers(h, 13, 3, np.empty(0, np.uint64))
    assert n.sum() == 500 - 12 and (first == np.concatenate([[0], np.cumsum(n)[:-1]])).all()
    assert (least[1:] != least[:-1]).all() and len(least) < 200


def test_lines_compared_together_are_judged_like_single_ones():
    """Edited, moved and unlike lines of many lengths (word boundaries of 64 included), some characters far apart."""
    r, s, t = random.Random(5), [], []
    for i in range(1500):
        a = [r.choice("abc é日") for _ in range((1, 5, 30, 63, 64, 65, 127, 128, 129, 300)[i % 10])]
        b = a[len(a) // 8 :] + a[: len(a) // 8] if r.random() < 0.2 else list(a)
        for _ in range(r.randint(0, len(a) // 3)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randint(0, 1)] = r.choice(["", "a", "é"])
        s.append("".join(a))
        t.append("".join(b))
    for percent in (60, 80, 90):
        want = [line_dedup.alike(x, y, percent) for x, y in zip(s, t, strict=True)]
        assert line_dedup.alikes(s, t, percent).tolist() == want and any(want) and not all(want)


def test_open_buckets_are_compared_in_tasks(spark, monkeypatch):
    """Buckets of one block, of several, and a class given before: every two classes with a link are joined, and pairs are no rows."""
    monkeypatch.setattr(common, "CELL", 40)
    r = random.Random(7)
    lines = {}
    for i in range(60):  # groups of three: the first two alike, the third far from both
        a = "".join(r.choice("abcdefgh ") for _ in range(90))
        lines |= {b"%03d" % (3 * i): a, b"%03d" % (3 * i + 1): a[:40] + "xyz" + a[44:], b"%03d" % (3 * i + 2): "".join(r.choice("abcdefgh ") for _ in range(90))}
    bits = line_dedup.simhashes([x.encode() for x in lines.values()]).view(">i8").astype("int64").tolist()
    texts = spark.createDataFrame([(bytearray(k), x, *b) for (k, x), b in zip(lines.items(), bits, strict=True)], "node binary, words string, hi long, lo long")
    open_ = spark.createDataFrame([(key, bytearray(k), bytearray(k)) for key in (1, 2) for k in lines if key == 1 or int(k) < 30], "key long, node binary, class binary")
    found = spark.createDataFrame([], "node binary, component binary")
    compare = lambda cells: line_dedup.compared(cells, texts, 80)
    got = {(bytes(x.node), bytes(x.component)) for x in common.in_cells(open_, found, compare).collect() if x.node != x.component}
    near = line_dedup.near_pairs
    assert got == {(b"%03d" % (3 * i + 1), b"%03d" % (3 * i)) for i in range(60)}
    signed = np.array([-1, 1, -1], np.int64).view(np.uint64)
    same = near(np.zeros(3, int), np.zeros(3, bool), np.zeros(3, int), np.arange(3), np.full(3, 90), signed, signed, 80)
    assert same.tolist() == [[0, 2]]


def test_long_unlike_lines_are_ruled_out_on_the_way(monkeypatch):
    r = random.Random(8)
    looks = []
    least = line_dedup._least_end
    monkeypatch.setattr(line_dedup, "_least_end", lambda *a: looks.append(least(*a)) or looks[-1])
    for n in (257, 300, 700):
        a = "".join(r.choice("abcdefg ") for _ in range(n))
        for changes in (0, n // 6, n // 4, n):
            b = list(a)
            for _ in range(changes):
                k = r.randrange(len(b) + 1)
                b[k : k + r.randint(0, 1)] = r.choice(["", "x", "a"])
            b, seen = "".join(b), len(looks)
            d = edits(a, b)
            assert [line_dedup.close(a, b, k) for k in (d - 1, d, d + 1)] == [False, True, True] and line_dedup.close(b, a, d) and all(x <= d for x in looks[seen:])
        assert not line_dedup.close(a, a[::-1], n // 5) and looks[-1] > n // 5
