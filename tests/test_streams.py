import os
import random

import pytest
from pyspark.sql import functions as F

from postings.operators import keyed, ledgers
from postings.streaming import delivery_states as d
from postings.streaming import incremental, upserts


def files_under(path):
    return {os.path.join(top, f) for top, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_small_batch_rewrites_its_share_of_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(20_000).selectExpr("id AS k", "0 AS at", "id AS v", "'mine' AS part")
    upserts.merge(path, base.drop("part"), 0, ["k"], ["at"], parts=32)
    before = files_under(path)
    assert len(before) == 32
    upserts.merge(path, spark.createDataFrame([(5, 1, -5), (9, 1, -9), (None, 1, 0)], "k long, at int, v long"), 1, ["k"], ["at"])
    after = files_under(path)
    assert len(after - before) <= 3 and before - after == set()  # the version before stays readable
    got = upserts.current(spark, path)
    assert got.count() == 20_001 and got.where("at = 1").count() == 3 and upserts.current(spark, path, 0).count() == 20_000
    upserts.merge(path, spark.createDataFrame([(5, 0, 77), (9, 2, 78)], "k long, at int, v long"), 2, ["k"], ["at"])
    assert {(r.k, r.v) for r in upserts.current(spark, path).where("k in (5, 9)").collect()} == {(5, -5), (9, 78)}  # a late duplicate loses
    upserts.merge(path, spark.createDataFrame([(1, 9, 1)], "k long, at int, v long"), 3, ["k"], ["at"])
    assert upserts.versions(upserts.Folder(spark, path)) == [2, 3]
    assert len(files_under(path)) <= 32 + 3 + 3  # old versions' files are gone


def test_replays_and_crashes_before_the_marker_change_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one = spark.range(100).selectExpr("id AS k", "0 AS at", "id AS v")
    two = spark.range(50, 150).selectExpr("id AS k", "1 AS at", "-id AS v")
    upserts.merge(path, one, 0, ["k"], ["at"], parts=4)
    want = sorted(map(tuple, upserts.current(spark, path).collect()))
    with monkeypatch.context() as m:
        m.setattr(upserts.Folder, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upserts.merge(path, two, 1, ["k"], ["at"])
    assert sorted(map(tuple, upserts.current(spark, path).collect())) == want  # written, not published
    upserts.merge(path, two, 1, ["k"], ["at"])
    now = sorted(map(tuple, upserts.current(spark, path).collect()))
    assert now == sorted(map(tuple, keyed.latest_by(one.unionByName(two), ["k"], ["at"]).collect()))
    held = files_under(path)
    for number in (0, 1):  # batches that run again
        upserts.merge(path, one, number, ["k"], ["at"])
    assert files_under(path) == held and sorted(map(tuple, upserts.current(spark, path).collect())) == now
    upserts.merge(path, one.limit(0), 2, ["k"], ["at"])
    assert upserts.current(spark, path).count() == 150
    with pytest.raises(FileNotFoundError):
        upserts.current(spark, str(tmp_path / "none"))


def attempts(seed):
    """Repeats, attempts that come late, open ones that get their outcome later."""
    rnd, rows = random.Random(seed), []
    for k in range(12):
        for i in range(rnd.randrange(1, 5)):
            rows.append((k, 3600 * (i + k), k * 10 + i, rnd.choice([False, False, False, True, None]), f"e{i}"))
    files = [[] for _ in range(4)]
    for r in rows:
        files[rnd.randrange(4)].append(r)
        if rnd.random() < 0.4:
            files[3].append(r)
    return rows, files


def test_states_of_a_stream_equal_the_batch_fold(spark, tmp_path):
    schema = "k long, s long, attempt_id long, ok boolean, error string"
    rows, files = attempts(5)
    for part in files:
        spark.createDataFrame(part, schema).withColumn("at", F.timestamp_seconds("s")).drop("s").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.sql("SELECT 99L AS k, 990L AS attempt_id, false AS ok, 'later' AS error, current_timestamp() + INTERVAL 1 DAY AS at").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    log = str(tmp_path / "log")

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{log}/n={number}")

    stream = incremental.files(spark, str(tmp_path / "in"), "k long, attempt_id long, ok boolean, error string, at timestamp", 1)
    q = d.delivery_states(stream, ["k"]).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    changes = spark.read.parquet(log)
    got = d.latest_states(changes, ["k"]).where("k < 90")
    batch = ledgers.delivery_state(spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds("s")), ["k"])
    columns = ["k", "attempts", "state", "error", "last_at"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
    states = {r.k: r.state for r in batch.collect()}
    due = {r.k for r in changes.where("event = 'retry_due'").collect()}
    assert {k for k, s in states.items() if s == "failed"} <= due <= {r.k for r in changes.where("state = 'failed'").collect()} - {99}  # 99 is due tomorrow
    assert {r.k for r in changes.where("event = 'dead_letter'").collect()} >= {k for k, s in states.items() if s == "dead-letter"}
    assert d.retry_delay(1).total_seconds() == 300 and d.retry_delay(3).total_seconds() == 1200 and d.retry_delay(99).total_seconds() == d.RETRY_MOST


def test_deliveries_share_calls_by_buckets_and_keep_their_keys_exactly(spark, tmp_path):
    from datetime import datetime

    big = 2**62 + 1
    rows = [(None if i % 50 == 0 else big + i, datetime(2024, 1, 1, 0, 0, 0, 123456 + i % 3), datetime(2024, 1, 2, 0, n), i * 10 + n, bool(i % 5 == 0) if n else False, f"e{n}") for i in range(300) for n in range(i % 4 + 1)]
    schema = "k long, t timestamp, at timestamp, attempt_id long, ok boolean, error string"
    for half in (rows[::2], rows[1::2]):
        spark.createDataFrame(half, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    calls = spark.sparkContext.accumulator(0)

    class Counted(d.DeliveryFold):
        def __call__(self, *a):
            calls.add(1)
            return super().__call__(*a)

    log, plain = str(tmp_path / "log"), d.DeliveryFold
    d.DeliveryFold = Counted
    try:
        stream = incremental.files(spark, str(tmp_path / "in"), schema, 1)
        changes = d.delivery_states(stream, ["k", "t"], buckets=8)
        keep = lambda batch, number: batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{log}/n={number}")
        changes.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    finally:
        d.DeliveryFold = plain
    assert 0 < calls.value <= 2 * 8  # two batches, however many deliveries
    columns = ["k", "t", "attempts", "state", "error", "last_at"]
    got = d.latest_states(spark.read.parquet(log), ["k", "t"]).select(columns).collect()
    want = ledgers.delivery_state(spark.createDataFrame(rows, schema), ["k", "t"]).select(columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and any(r.k is None for r in got) and any(r.k == big + 1 for r in got)
