import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from postings.llm.mixing import mix
from postings.llm.token_files import Encoder, TokenFile, pack, public_vocabulary, to_file, token_files, unpack

TEXTS = ["plain words here.", "two  spaces, it's\n\na line", " lead and trail ", "", None, "tab\tand\r\nreturn   x", "<|endoftext|> in text", "É ünïcode, 12 345.6 %%% 中文.", "end.\n", "\nstart ok"]


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 10_001).astype(np.uint32)
    assert (unpack(pack(ids, bits), bits, len(ids)) == ids).all()
    file = TokenFile(to_file([5, None], [10_000, 1], ids, bits, block=100))
    assert (file.ids() == ids).all() and file.doc_ids == [5, None]
    assert (file.ids(95, 3_333) == ids[95:3_333]).all() and len(file.ids(7, 7)) == 0


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    plain, encode = Tokenizer.from_file(public_vocabulary()), Encoder(public_vocabulary(), most=5)
    for t in TEXTS * 2:
        assert np.frombuffer(encode(t), "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_files_give_every_document(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_vocabulary())
    rows = [(i * 3 % 10, t, 0) for i, t in enumerate(TEXTS)] + [(None, "no id", 1), (4, "again", 2), (4, "again", 2)]
    got = token_files(spark, spark.createDataFrame(rows, "doc_id long, text string, start int")).collect()
    ids = [(d, [*plain.encode(t or "", add_special_tokens=False).ids, 0]) for d, t, _ in rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids)
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (-1 if r.doc_id is None else r.doc_id) >= last
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    assert token_files(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def draws(doc, rate, seed="mix-1"):
    u = int(hashlib.md5(f"{seed}:{doc}".encode()).hexdigest()[:13], 16) / 2**52
    p = total = math.exp(-rate)
    n = 0
    while total <= u:
        n += 1
        p *= rate / n
        total += p
    return n


def test_poisson_replication(spark):
    rows = [(i, f"t{i}", "a" if i % 3 else ("b" if i % 2 else None), i) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix int")
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0), (None, 1.0)], "source string, weight double")
    got = Counter(r.doc_id for r in mix(df, weights=weights).collect())
    sizes = Counter(r[2] for r in rows)
    rate = {s: {"a": 1, "b": 3, None: 1}[s] / 5 * 600 / sizes[s] for s in sizes}
    assert got == Counter({r[0]: n for r in rows if (n := draws(r[0], rate[r[2]]))})
    again = mix(df.repartition(7), weights=weights).collect()
    assert Counter(r.doc_id for r in again) == got
    assert [r.mix_key for r in again] != sorted(r.doc_id for r in again)


def test_mixing_odd_rows(spark):
    rows = [(None, None, None), (1, "x", "only"), (1, "x", "only")]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), temperature=1.0).collect()
    n = draws(1, 1.0), draws("null", 1.0)
    assert Counter(r.doc_id for r in got) == Counter({1: 2 * n[0], None: n[1]}) - Counter()
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
    none = spark.createDataFrame([("z", 1.0)], "source string, weight double")
    assert mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=none).collect() == []


def test_any_rate_and_clashing_columns(spark):
    rows = [(i, "a", "text", "mine") for i in range(3000)] + [(3000, "b", "text", "mine")]
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_id string, mix_source string")
    weights = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "source string, weight double")
    got = mix(df, weights=weights).groupBy("source", "mix_id", "mix_source").count().collect()
    n = {r.source: r["count"] for r in got}
    assert {(r.mix_id, r.mix_source) for r in got} == {("text", "mine")}
    assert abs(n["b"] - 2700.9) < 6 * 52 and 200 < n["a"] < 400
    assert mix(df, weights=weights).where("source = 'b'").select("mix_copy").distinct().count() == n["b"]
