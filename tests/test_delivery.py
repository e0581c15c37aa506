from pyspark.sql import functions as F

from postings.operators import delivery, reports


def test_batches_and_hashes(spark):
    jobs = spark.createDataFrame([(i, "x" if i % 2 else None) for i in range(7)], "id long, t string")
    rows = delivery.payloads(jobs, {"t": F.col("t"), "id": F.col("id")}, "id").withColumn("run", F.lit("r"))
    assert {r.payload for r in rows.collect()} >= {'{"id":0}', '{"id":1,"t":"x"}'}
    got = {r.chunk: (r.n, r.body) for r in delivery.batches(rows, ["run"], ["id"], 3).collect()}
    assert [got[i][0] for i in range(3)] == [3, 3, 1] and got[2][1] == '[{"id":6}]'
    again = delivery.batches(rows.repartition(5), ["run"], ["id"], 3)
    assert {r.chunk_hash for r in again.collect()} == {r.chunk_hash for r in delivery.batches(rows, ["run"], ["id"], 3).collect()}
    try:
        delivery.batches(rows, ["run"], ["id"], 101)
        raise AssertionError("too large a batch must be refused")
    except ValueError:
        pass


def test_outcomes_and_runs(spark):
    df = spark.createDataFrame([(200,), (404,), (422,), (503,), (None,)], "s int")
    assert [r[0] for r in df.select(delivery.outcome(F.col("s"))).collect()] == ["sent", "retryable", "final", "retryable", "retryable"]
    attempts = spark.createDataFrame([("a", 1, 503), ("a", 2, 200), ("a", 3, 503), ("b", 1, 422)], "run string, n int, status int")
    assert dict(delivery.halved_sizes(attempts, ["run"], ["n"], 25).collect()) == {"a": 6, "b": 25}
    runs = spark.createDataFrame([("x-sync",), ("x-retry-01",), ("x",), ("y-normalize-retry-02",)], "run string")
    assert dict(delivery.next_retry_id(runs, "run").collect()) == {"x": "x-retry-02", "y": "y-retry-02"}


def test_detail_and_reports(spark):
    listed = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k long")
    detail = spark.createDataFrame([(1, "d", 200), (2, None, 404), (3, None, 503), (1, None, 0)], "k long, payload string, status int")
    got = {r.k: (r.completeness, r.missing_reason, r.retryable) for r in delivery.with_detail(listed, detail, "k", "status").collect()}
    assert got == {1: ("complete", None, None), 2: ("partial", "not_found", False), 3: ("partial", "source_error", True), 4: ("partial", "not_attempted", None)}
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "g string, v int")
    found = reports.metrics(df, F.col("g"), {"n": F.count(F.lit(1)), "total": F.sum("v")})
    assert {(r.scope, r.metric): r.value for r in found.collect()} == {("a", "n"): 2, ("a", "total"): 4, ("unknown", "n"): 1, ("unknown", "total"): 5, ("all", "n"): 3, ("all", "total"): 9}
    assert [(r.scope, r.name) for r in reports.warnings(found, [("big", "total", "warning", 8.0)]).collect()] == [("all", "big")]
    s = spark.createDataFrame([(0, 0, 0), (3, 1, 2), (3, 0, 3), (3, 0, 1), (3, 0, 0)], "a int, s int, f int")
    assert [r[0] for r in s.select(reports.zero_sent_reason(F.col("a"), F.col("s"), F.col("f"))).collect()] == ["no_eligible_jobs", None, "all_failed", "some_failed", "nothing_pending"]
    state = spark.createDataFrame([("a", "complete"), ("a", "partial"), ("a", None)], "g string, s string")
    assert tuple(reports.completeness(state, "g", F.col("s")).first()) == ("a", 3, 1, 1, 1, 0.3333)
