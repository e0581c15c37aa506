import os

import pytest
from pyspark.sql import functions as F

from postings.functions import skills, wording
from postings.operators import runs
from postings.plans import export
from postings.sources import replay

DATA = "/root/testdata/sf0.001"


def tables(spark):
    return [spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("orders", "customer", "lineitem", "part", "events")]


def test_five_outputs_from_one_base(spark, tmp_path):
    orders, customer, lineitem, part, events = tables(spark)
    made = export.frames(orders, customer, lineitem, part, events)
    done = export.export(made)
    assert set(done.counts) == {"job_listings", "job_requirements", "job_skills", "job_user_signals", "job_model_dataset"}
    assert done.counts["job_listings"] == done.counts["job_model_dataset"] == done.counts["job_user_signals"] == orders.join(customer, F.col("c_custkey") == F.col("o_custkey")).count()
    assert all(done.counts[n] == df.count() == made[n].count() for n, df in done.outputs.items())
    assert done.dictionary.count() == sum(len(df.columns) for df in made.values())
    export.publish(done, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out/job_skills")).columns == made["job_skills"].columns


def test_empty_outputs_keep_their_headers(spark, tmp_path):
    orders, customer, lineitem, part, events = tables(spark)
    made = export.frames(orders.limit(0), customer, lineitem, part, events)
    done = export.export(made)
    assert set(done.counts.values()) == {0}
    export.publish(done, str(tmp_path / "out"))
    for name, df in made.items():
        files = [f for f in os.listdir(tmp_path / "out" / name) if f.endswith(".csv")]
        assert files and open(tmp_path / "out" / name / files[0]).read().strip().split(",") == df.columns


@pytest.mark.parametrize("planted,kind", [("write to a.b-c@mail.example.co please", "email"), ("call 0812-3456-7890 now", "phone"), ("+62 812 3456 789", "")])
def test_planted_personal_data_stops_the_export(spark, planted, kind):
    good = spark.createDataFrame([(1, "plain", 81234567890)], "k long, text string, n long")
    bad = good.unionByName(spark.createDataFrame([(2, planted, 0)], good.schema))
    if not kind:
        assert export.export({"a": bad}).counts == {"a": 2}
        return
    with pytest.raises(export.PrivateData) as e:
        export.export({"a": good, "b": bad})
    assert e.value.found == [("b", "text", kind, 1)]


def test_children_are_joined_once_and_give_the_operators_rows(spark):
    from postings.plans import dataset, relations

    orders, customer, lineitem, part, events = tables(spark)
    made = export.frames(orders, customer.where("c_custkey % 3 = 0"), lineitem, part, events)
    assert not any("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in (made["job_requirements"], made["job_skills"]))
    chosen = orders.join(customer.where("c_custkey % 3 = 0"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    want = dataset.requirement_rows(lineitem, part, chosen)
    assert made["job_requirements"].columns == want.columns and made["job_requirements"].exceptAll(want).isEmpty() and want.exceptAll(made["job_requirements"]).isEmpty()
    children = lineitem.select(F.col("l_orderkey").alias("listing"), F.col("l_partkey").alias("skill"), F.bround("l_discount", 4).alias("confidence"))
    entries = part.select(F.col("p_partkey").alias("skill"), F.col("p_name").alias("name"), F.col("p_type").alias("category"))
    want = relations.skill_rows(children, entries, chosen.select(F.col("o_orderkey").alias("listing"), F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_seen")))
    assert made["job_skills"].columns == want.columns and made["job_skills"].exceptAll(want).isEmpty() and want.exceptAll(made["job_skills"]).isEmpty()


def test_guard_runs_a_pattern_only_where_it_may_match(spark):
    texts = ["a.b@c.de", "a@b", "0812-3456-7890", "+62812 3456 7890", "62812 3456 7890", "x08123456789", "no 8 12", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = [F.count_if(F.col("t").rlike(p)).alias(k) for k, p in export.PRIVATE_VALUES.items()]
    found = export.private_values(df)
    assert df.agg(*(m.alias(k.split("|")[1]) for k, m in found.items())).first() == df.agg(*plain).first() == (1, 3)
    assert all("contains" in str(m).lower() for m in found.values())


def test_private_columns(spark):
    assert export.private_columns(["o_orderkey", "last_user_id", "Email", "n_events", "emailed", "work_phone_2"]) == ["last_user_id", "Email", "work_phone_2"]
    with pytest.raises(export.PrivateData):
        export.export({"a": spark.range(1).withColumnRenamed("id", "user_id")})


def test_replay_resumes_and_equals_the_batch(spark, tmp_path):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    payloads = spark.createDataFrame([(f"s{i}", f'{{"n": {i}}}') for i in range(5)], "source string, payload string")
    batch = replay.replayed(payloads, "source", "payload", 7, now)
    assert batch.where("source = 's1' and external_id = 's1-fixture-7'").first().source_timestamp.minute == 53
    sizes = []

    def keep(df, number):
        sizes.append(df.count())
        df.write.mode("overwrite").parquet(f"{tmp_path}/log/n={number}")
        if len(sizes) == 3 and sum(sizes) < 35:
            raise RuntimeError("lost after its write")  # the batch runs again

    for _ in range(2):
        q = replay.replay_stream(payloads, "source", "payload", 7, now, 8).writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).start()
        try:
            q.processAllAvailable()
        except Exception:  # the planned loss
            assert len(sizes) == 3
        q.stop()
    assert max(sizes) == 8 and sizes[2] == sizes[3]
    got = spark.read.parquet(f"{tmp_path}/log").drop("n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_rewrites_equal_the_plain_fold(spark):
    import re

    said = ["Minimal 3 tahun pengalaman dalam SQL", "gelar sarjana atau diploma, lebih disukai", "up to 5 year, 2 - 3 tahun", "Skill : Go   Pengalaman: 1", "nothing here\n at  all", "minimum of 2 years", "Kandidat yang mampu mengelola dan membuat untuk tim dengan baik", "", "MINIMUM 4 YEAR"]
    got = dict(spark.createDataFrame(list(enumerate(said)), "k long, t string").select("k", wording.rewritten(F.col("t"))).collect())
    for k, t in enumerate(said):
        for pattern, to in wording.REWRITES:
            t = re.sub(pattern, to.replace("$", "\\"), t, flags=re.I)
        assert got[k] == re.sub(r"\s+", " ", t).strip()
    block = dict(spark.createDataFrame([(0, "a • b - c"), (1, "<p>x</p> <ul><li>y</li></ul>"), (2, " ▪ "), (3, None)], "k long, t string").select("k", wording.block(F.col("t"))).collect())
    assert block[0] == "a . b. c" and block[2] is None and block[3] is None and "<" not in block[1]


def test_repairs(spark):
    one = spark.createDataFrame([(["Masters of SQL", "masters of sql", "Works daily"],)], "v array<string>").select(skills.typed(F.col("v")).alias("t")).first().t
    assert [(x.type, x.value) for x in one] == [("SKILL", "Masters of SQL"), ("OTHER", "Works daily")]
    sent = spark.createDataFrame([(1, None), (1, None), (2, "a")], "run long, id string")
    added = runs.handoff(sent.limit(0), sent, ["run", "id"])
    assert added.count() == 2 and runs.handoff(added, sent, ["run", "id"]).isEmpty()
