import random
import re
import zlib
from collections import Counter

from postings.llm import quality_classifier, toxicity
from postings.llm.labelled import held_out
from postings.llm.quality_rules import quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def sentences(rnd, n):
    clean = ["river", "stone", "paper", "green", "market", "window", "planet", "number", "letter", "garden", "winter", "summer", "bridge", "school", "orange", "silver"]
    return ". ".join(" ".join(rnd.choice(clean) + rnd.choice(["", "s", "ly", "ing"]) for _ in range(8)) for _ in range(n))


def labelled(n=600):
    rnd = random.Random(4)
    rows = []
    for d in range(n):
        text, toxic = sentences(rnd, 4), d % 3 == 0
        if toxic:
            w = text.split(" ")
            for _ in range(2):
                w.insert(rnd.randrange(len(w)), rnd.choice(["blorfhead", "zugwump", "krudlick"]))
            text = " ".join(w)
        rows.append((d, text, int(not toxic), int(toxic)))
    return rows


def test_toxicity_held_out_and_disguised(spark):
    rows = labelled()
    docs = spark.createDataFrame([(d, t) for d, t, *_ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, q, x) for d, _, q, x in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, landmarks=80, clean_words=500)
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, model).collect()}
    test = [(got[d].predicted, x) for d, _, _, x in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got)
    assert sum(a == b for a, b in test) / len(test) > 0.98
    odd = [(1, "what a zug.wump you are"), (2, "blorrfhead"), (3, None), (4, ""), (None, "green river"), (5, "x" * 5000), (6, "a kr-udlick here")]
    out = {r.doc_id: r for r in toxicity.toxicity_scores(spark.createDataFrame([(d, t, 0.5) for d, t in odd], "doc_id long, text string, score double"), model).collect()}
    assert [out[d].predicted for d in (1, 2, 3, 4, None, 5, 6)] == [1, 1, 0, 0, 0, 0, 1]
    assert all(0 <= r.score <= 1 for r in out.values())
    blank = toxicity.fit(docs.limit(0), labels)
    assert [r.predicted for r in toxicity.toxicity_scores(docs.limit(2), blank).collect()] == [0, 0]


def test_subsequence_weights_are_a_kernel():
    keys, weights = toxicity.subsequences(["stupid", "st.upid", "garden"])
    dense = [Counter() for _ in keys]
    for d, k, w in zip(dense, keys, weights):
        for a, b in zip(k.tolist(), w.tolist()):
            d[a] += b if a >= 0 else 0
    dot = lambda i, j: sum(v * dense[j][k] for k, v in dense[i].items())
    assert abs(dot(0, 0) - 1) < 1e-4 and dot(0, 1) > 0.5 > 0.1 > dot(0, 2)


def test_classifier_learns_and_scores_all(spark):
    rows = labelled()
    docs = spark.createDataFrame([(d, t) for d, t, *_ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, q, x) for d, _, q, x in rows] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, labels, "quality")
    got = {r.doc_id: r for r in quality_classifier.quality_scores(docs, model).collect()}
    test = [(got[d].predicted, q) for d, _, q, _ in rows if got[d].held_out]
    assert len(test) > 150 and sum(a == b for a, b in test) / len(test) > 0.97
    odd = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (1, "", "b")], "doc_id long, text string, score string")
    out = quality_classifier.quality_scores(odd, model, keep=["score"]).collect()
    assert len(out) == 3 and {r.keep_score for r in out} == {"a", "b"} and all(0 <= r.score <= 1 for r in out)
    assert docs.select(held_out(docs.doc_id).alias("h")).where("h").count() == sum(zlib.crc32(str(d).encode()) % 3 == 1 for d, *_ in rows)
    one = quality_classifier.fit(docs, labels.where("quality = 1"), "quality")
    assert quality_classifier.quality_scores(docs.limit(1), one).first().predicted == 1


def brute_rules(text):
    t = text or ""
    w = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    grams = list(zip(w, w[1:], w[2:]))
    seen, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            cover |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_rules_match_brute_force(spark):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["a", "bb", "Ünï", "#x", "|", "end."]) for _ in range(rnd.randint(0, 200))) for _ in range(60)]
    texts += [None, "", " \n\t\x0b ", "one", "a b", "a a a", "a b c a b c", "x\nx\n\nx\r\n x", "w " * 3000, sentences(rnd, 20), "SHOUT!! " * 10 + sentences(rnd, 20).upper()]
    rows = list(enumerate(texts)) + [(None, "a b c")]
    got = quality_rules(spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, n_words int")).collect()
    assert len(got) == len(rows)
    for r in got:
        n = brute_rules(dict(rows)[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n, r
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and (not r.base_failed or not r.kept)
    by = {r.doc_id: r for r in got}
    assert by[69].kept and not by[70].kept
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_texts_use_whole_keys(spark, monkeypatch):
    from postings.llm import quality_rules as module

    monkeypatch.setattr(module, "PLACE_BITS", 4)  # texts of 16 words are long ones then
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(10, 60)))) for i in range(30)]
    for r in module.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.n_repeat_words == brute_rules(dict(rows)[r.doc_id])[4]


def test_cascade_order_is_by_rejection_per_cost(spark):
    from postings.llm.quality_rules import Rule, cascade_order

    rows = spark.range(500).selectExpr("id as doc_id", "repeat('abc def ', 200) as text", "id % 10 as n_words").cache()
    cheap, dear, idle = Rule("cheap", "n_words < 4"), Rule("dear", "length(regexp_replace(text, '[^\\\\p{Lu}]', '')) >= 0 and n_words < 5"), Rule("idle", "n_words > 20")
    assert [r.name for r in cascade_order(rows, (idle, dear, cheap))] == ["cheap", "dear", "idle"]


def test_ten_calls_give_one_order(spark):
    from postings.llm.quality_rules import RULES, cascade_order, with_base

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sample = with_base(docs, docs["text"], docs["doc_id"]).cache()
    orders = {tuple(r.name for r in cascade_order(sample, RULES)) for _ in range(10)}
    sample.unpersist()
    assert len(orders) == 1
