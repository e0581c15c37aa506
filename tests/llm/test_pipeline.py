import random
import zlib

import corpus_pipeline
import numpy as np
from postings.llm.token_files import public_vocabulary

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "pu", "ri", "sa", "te") for b in ("dor", "fen", "gul", "hast", "jim", "kord", "lum", "vex")]


def make(tmp):
    rnd = random.Random(12)
    good = lambda: ". ".join(" ".join(rnd.choice(WORDS) for _ in range(9)) for _ in range(8))
    junk = lambda: " | ".join(rnd.choice(WORDS) + "###" for _ in range(60))
    docs, labels = [], []
    for d in range(300):
        bad = d % 4 == 0
        docs.append((d, junk() if bad else good(), "en", f"s{d % 3}", 0))
        labels.append((d, int(not bad), 0))
    item = " ".join(rnd.choice(WORDS) for _ in range(20))
    docs += [(400 + i, docs[i][1] + " " + WORDS[i], "en", "s0", 0) for i in (1, 2, 3)]
    docs += [(500, good() + " " + item + ". " + good(), "en", "s1", 0)]
    return docs, labels, [(1, item)]


def test_stages(spark, tmp_path):
    docs, labels, bench = make(tmp_path)
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    names, stages = zip(*corpus_pipeline.STAGES)
    assert len(set(names)) == 5
    df, columns = spark.read.parquet(f"{tmp_path}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    kept = []
    for i, stage in enumerate(stages[:4]):
        df = stage(spark, df, str(tmp_path)).cache()
        assert df.columns == columns
        kept.append([r.doc_id for r in df.collect()])
    good = {d for d, q, _ in labels if q} | {401, 402, 403, 500}
    assert set(kept[0]) == good
    assert set(kept[1]) == good - {401, 402, 403}
    assert set(kept[2]) == good - {401, 402, 403, 500}
    assert set(kept[3]) < set(kept[2]) and 0.6 < len(kept[3]) / len(kept[2]) < 1.4
    from tokenizers import Tokenizer

    plain, texts = Tokenizer.from_file(public_vocabulary()), {d: t for d, t, *_ in docs}
    out = stages[4](spark, df, str(tmp_path)).collect()
    want = {d: zlib.crc32(np.array([*plain.encode(texts[d], add_special_tokens=False).ids, 0], "<u4").tobytes()) for d in set(kept[3])}
    assert sorted(r.doc_id for r in out) == sorted(kept[3]) and all(r.ids_crc32 == want[r.doc_id] for r in out)


def test_run_gives_the_stages_result(spark, tmp_path):
    docs, labels, bench = make(tmp_path)
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and [r.start for r in sorted(out, key=lambda r: r.start)][0] == 0
