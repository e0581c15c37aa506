import hashlib
import random
import re
import zlib

from postings.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n long, root string, least string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(ts)] for c, ts in own.items()}
    seqs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    nodes = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    words = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids.get(k, [])) or 1
        saved[k] = (len(nodes[k]) - 1) * words(k) + sum(saved[x] for x in kids.get(k, []))
    out = []
    for k, cs in nodes.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(seqs[c]) == len(k))
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(cs), len(k), parent, len(cs), len(kids.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, chunk):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    got = prefix_trie(df, chunk=chunk)
    assert got.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def made(seed, convs, longest, texts=3):
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rnd.choice([1, 2, longest, rnd.randrange(1, longest + 1)])):
            rows.append((c, t, rnd.choice(["user", "bot"]) if rnd.random() < 0.2 else "user", " ".join(["hi"] * rnd.choice([0, 1, texts]))))
    return rows


def test_trie_equals_brute_force(spark):
    check(spark, made(1, 60, 7), 512)


def test_any_chunk_gives_the_same_trie(spark):
    rows = made(2, 30, 21, 1)
    check(spark, rows, 4)  # three scales


def test_nulls_ties_repeats_empty_and_negative_ids(spark):
    rows = [(None, 1, "user", "lost"), (3, None, "a", "x y"), (3, None, None, None), (3, 0, "a", "x"), (3, 0, "a", "x"), (20, 5, "b", "p\tq r"), (21, 5, "b", "own"), (21, 6, "b", "own two"),
            (-5, 1, "u", "neg"), (-5, 2, "u", "neg"), (-5, 3, "u", "neg"), (-5, 4, "u", "neg"), (-5, 5, "u", "neg"), (400, 1, "u", "long " * 5000), (402, 1, "u", "one"), (404, 2, "u", "")]
    check(spark, rows, 512)
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert prefix_trie(spark.createDataFrame([(None, 1, "u", "t", 1, "", "")], SCHEMA)).isEmpty()


def test_copies_of_one_conversation_and_a_turnless_table(spark):
    rows = [(c * 20, t, "u", f"t{t}") for c in range(400) for t in range(4)]
    check(spark, rows, 2)
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    check(spark, [(alone, 1, "u", "taken away")], 512)  # its opening is replaced by a base that isn't there
