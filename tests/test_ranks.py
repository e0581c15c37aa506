import random

from pyspark.sql import functions as F

from postings.operators import keyed, ranks


def hot_rows(spark):
    """One key has nearly all rows, the null key some; dealt over many partitions."""
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.8 else rnd.choice(["a", "b", None]), rnd.randrange(400), i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "k string, v long, id long").repartition(9)


def test_numbers_totals_and_chunks_of_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows, df = hot_rows(spark)
    df = df.withColumn("part", F.lit("mine"))  # a working name
    got = ranks.running_total(ranks.numbered(df, ["k"], ["v", "id"], "n"), ["k"], ["v", "id"], F.col("v"), "total")
    assert set(got.columns) == {"k", "v", "id", "part", "n", "total"} and got.where("part <> 'mine'").isEmpty()
    want, seen = {}, {}
    for k, v, i in sorted(rows, key=lambda r: (r[1], r[2])):
        n, t = seen.get(k, (0, 0))
        want[i] = seen[k] = (n + 1, t + v)
    assert {r.id: (r.n, r.total) for r in got.collect()} == want
    cut = keyed.chunks(df, ["k"], ["v", "id"], 7)
    assert {r.id: r.chunk for r in cut.collect()} == {i: (n - 1) // 7 for i, (n, _) in want.items()}
    assert {r.n for r in ranks.numbered(df, [], ["id"], "n").collect()} == set(range(1, 3001))
    hot = ranks.dealt(df, ["k"], ["v", "id"], "at", "test").where("k = 'hot'").groupBy("at").count().collect()
    assert len(hot) > 1 and max(r["count"] for r in hot) < 2400  # no task holds the key
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_previous_rows_cross_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows, df = hot_rows(spark)
    got = {r.id: (r.was, r.later) for r in ranks.with_previous(df, ["k"], ["v", "id"], {"v": "was"}, "later").collect()}
    last = {}
    for k, v, i in sorted(rows, key=lambda r: (r[1], r[2])):
        assert got[i] == (last.get(k), k in last)
        last[k] = v
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nearest_rank_equals_the_sorted_list(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows, df = hot_rows(spark)
    df = df.select("k", F.when(F.col("v") % 7 != 3, F.col("v")).alias("v")).unionByName(spark.createDataFrame([("none", None), ("one", 5)], "k string, v long"))
    got = {r.k: (r.low, r.mid, r.high, r.top) for r in ranks.nearest_rank(df, ["k"], "v", {"low": 0.0, "mid": 0.5, "high": 0.95, "top": 1.0}).collect()}
    lists = {}
    for k, v, _ in rows:
        if v % 7 != 3:
            lists.setdefault(k, []).append(v)
    want = {"none": (None,) * 4, "one": (5,) * 4}
    for k, vs in lists.items():
        vs.sort()
        want[k] = tuple(vs[max(1, -(-int(p * len(vs) * 100) // 100)) - 1] for p in (0.0, 0.5, 0.95, 1.0))
    assert got == want
    assert ranks.nearest_rank(df.limit(0), ["k"], "v", {"mid": 0.5}).isEmpty()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_upsert_keeps_columns_named_like_its_own(spark):
    stored = spark.createDataFrame([(1, 10, "x")], "k long, new long, row string")
    got = keyed.upsert(stored, spark.createDataFrame([(1, 11, "y"), (2, 5, "z")], "k long, new long, row string"), ["k"], ["new"], keep=["row"])
    assert sorted(map(tuple, got.collect())) == [(1, 11, "x"), (2, 5, "z")]
