import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postings.llm import language

DATA = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rnd = np.random.default_rng(0)
    trans, start = rnd.random((3, 3)) + 0.1, rnd.random(3) + 0.1
    sizes = [5, 1, 3, 6]
    emit = rnd.random((sum(sizes), 3)) + 0.05
    begins = np.zeros(sum(sizes), bool)
    begins[np.cumsum([0, *sizes[:-1]])] = True
    post, moves = language.marginals(emit, begins, trans, start)
    want, steps, at = np.zeros_like(post), np.zeros((3, 3)), 0
    for n in sizes:
        total, part, pairs = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=n):
            p = start[path[0]] * np.prod([emit[at + i, y] for i, y in enumerate(path)]) * np.prod([trans[a, b] for a, b in itertools.pairwise(path)])
            total += p
            for i, y in enumerate(path):
                part[i, y] += p
            for a, b in itertools.pairwise(path):
                pairs[a, b] += p
        want[at : at + n], steps, at = part / total, steps + pairs / total, at + n
    assert np.allclose(post, want) and np.allclose(moves, steps)


def test_marginals_of_long_clear_and_contradictory_chains():
    emit = np.full((4000, 2), np.exp(language.LEAST))
    emit[np.arange(4000), np.arange(4000) // 7 % 2] = 1.0
    post, _ = language.marginals(emit, np.arange(4000) == 0, np.array([[5.0, 0.1], [0.1, 5.0]]), np.ones(2))
    assert np.isfinite(post).all() and (post.argmax(1) == np.arange(4000) // 7 % 2).all()


def spanish_and_english():
    es, en = "el la que con para una casa gato perro grande ñandú niño mañana".split(), "the which with for one house cat dog thing weight through though".split()
    rnd = np.random.default_rng(2)
    runs = [[str(x) for x in rnd.choice(ws, 12)] for _ in range(120) for ws in (es, en)]
    return language.learn(runs, ["es", "en"] * 120), es, en


def test_code_switched_words_are_labelled_one_by_one():
    model, es, en = spanish_and_english()
    text = en[:8] + es[:8] + en[4:12]
    post, owner = model.word_labels([text, es])
    assert [model.labels[k] for k in post.argmax(1)[:24]] == ["en"] * 8 + ["es"] * 8 + ["en"] * 8
    assert owner.tolist() == [0] * 24 + [1] * len(es)
    unseen, _ = model.word_labels([["whithing", "throughth", "ñañero"]])  # by affixes and inner n-grams alone
    assert [model.labels[k] for k in unseen.argmax(1)] == ["en", "en", "es"]
    again, score = model.predict([" ".join(text), None, "", "12 % -- _", "𝒳" * 3, "CASA " * 200_000])
    assert again[0] == "en" and again[1:4] == ["und"] * 3 and again[4] != "und" and again[5] == "es"
    assert 0.6 < score[0] < 0.7 and list(score[1:4]) == [0, 0, 0] and score.max() <= 1


def test_nulls_repeats_clashing_columns_and_nothing_learned(spark):
    model, _, en = spanish_and_english()
    rows = [(1, " ".join(en), "x", 5.0), (1, " ".join(en), "x", 5.0), (None, "la casa", None, 1.0), (3, None, "en", None), (4, "", None, None), (5, "42", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    got = language.languages(df, model).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1
    assert sorted((str(r.doc_id), r.held_out, r.lang_pred) for r in got) == sorted((str(d), held(d), p) for d, p in [(1, "en"), (1, "en"), (None, "es"), (3, "und"), (4, "und"), (5, "und")])
    assert language.languages(df.limit(0), model).isEmpty()
    none = language.fit(df.withColumn("lang", F.lit(None).cast("string")))
    assert [r.lang_pred for r in language.languages(df, none).collect()] == ["und"] * 6
    one = language.fit(spark.createDataFrame([(i, "la casa", "es") for i in range(9)], "doc_id long, text string, lang string"))
    assert {(r.lang_pred, r.score) for r in language.languages(df.where("doc_id = 1"), one).collect()} == {("es", 1.0)}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language.fit(docs)
    got = language.languages(docs.drop("lang", "source"), model)
    right = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_fit_never_reads_held_out_rows_or_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    other = docs.withColumn("text", F.when(held, "zzz qqq").otherwise(F.col("text"))).withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = language.fit(docs), language.fit(other)
    assert a.labels == b.labels and np.array_equal(a.weights, b.weights) and np.array_equal(a.trans, b.trans)


@pytest.mark.parametrize("most", [1, 3])
def test_drawn_rows_are_bounded(spark, most, monkeypatch):
    seen = {}
    monkeypatch.setattr(language, "learn", lambda runs, names: seen.update(runs=runs, names=names))
    language.fit(spark.range(400).selectExpr("id AS doc_id", "repeat('uno dos tres ', 400) AS text", "if(id % 10 < 9, 'a', 'b') AS lang"), train_rows=most)
    assert 0 < len(seen["runs"]) <= 2 * most * language.RUNS and set(seen["names"]) == {"a", "b"}
