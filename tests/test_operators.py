import random

from pyspark.sql import functions as F

from postings.operators import keyed, ledgers, quality


def test_latest_and_upsert_are_idempotent_and_order_free(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(20), rnd.randrange(50), i, f"v{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k long, at long, id long, v string")
    want = {}
    for k, at, i, v in rows:
        want[k] = max(want.get(k, (-1, -1, "")), (at, i, v))
    for parts in (1, 3, 17):
        got = {r.k: (r.at, r.id, r.v) for r in keyed.latest_by(df.repartition(parts), ["k"], ["at", "id"]).collect()}
        assert got == want
    stored = keyed.latest_by(df.where("id < 100"), ["k"], ["at", "id"])
    once = keyed.upsert(stored, df.where("id >= 100"), ["k"], ["at", "id"], keep=["id"])
    twice = keyed.upsert(once, df.where("id >= 100"), ["k"], ["at", "id"], keep=["id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    old = {r.k: r.id for r in stored.collect()}
    assert all(r.id == old.get(r.k, r.id) for r in once.collect())


def test_dedup_decisions(spark):
    rows = [("a", 1, "s", "t", "c"), ("a", 2, "s", "t", "c"), ("a", 3, "s2", "t", "c"), ("a", 4, "s3", "t2", "c2"), (None, 5, "s", "t", "c"), ("b", 6, None, "t", "c"), ("b", 7, "x", "u", "d")]
    got = keyed.dedup_decisions(spark.createDataFrame(rows, "k string, n long, slug string, title string, company string"), "k", ["n"], "slug", "title", "company")
    assert {r.n: (r.action, r.reason) for r in got.collect()} == {
        1: ("insert", "new_identity"), 2: ("update", "duplicate_identity"), 3: ("update", "slug_drift"), 4: ("update", "identity_collision"), 5: ("quarantine", "missing_identity"),
        6: ("insert", "new_identity"), 7: ("update", "duplicate_identity"),
    }


def test_freshness_twice_changes_nothing(spark):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    rows = [("seen", "stale", "2024-01-01"), ("old", "active", "2024-01-10"), ("aging", "active", "2024-01-25"), ("young", "active", "2024-01-30"), ("gone", "expired", "2024-01-01")]
    jobs = spark.createDataFrame(rows, "k string, status string, at string").select("k", "status", F.col("at").cast("timestamp").alias("last_seen_at"))
    seen = spark.createDataFrame([("seen",), ("seen",)], "k string")
    swept = ledgers.freshness(jobs, seen, ["k"], now)
    assert {r.k: (r.status, r.transition) for r in swept.collect()} == {
        "seen": ("active", "reactivated"), "old": ("expired", "expired"), "aging": ("stale", "stale"), "young": ("active", "unchanged"), "gone": ("expired", "unchanged")
    }
    again = ledgers.freshness(swept.drop("transition"), seen, ["k"], now)
    assert {r.transition for r in again.collect()} == {"unchanged"}
    failed = ledgers.freshness(jobs, seen.limit(0), ["k"], now, run_ok=F.lit(False))
    assert {r.transition for r in failed.collect()} == {"unchanged"}


def test_delivery_states(spark):
    rows = [("a", 1, False, "e1"), ("a", 2, True, None), ("b", 1, False, "e1"), ("b", 2, False, "e2"), ("c", 1, None, None), ("d", 1, False, "x"), ("d", 2, False, "y"), ("d", 3, False, "z")]
    attempts = spark.createDataFrame(rows, "k string, n long, ok boolean, error string").select("k", F.timestamp_seconds("n").alias("at"), F.col("n").alias("attempt_id"), "ok", "error")
    got = {r.k: (r.state, r.error, r.attempts) for r in ledgers.delivery_state(attempts, ["k"]).collect()}
    assert got == {"a": ("sent", None, 2), "b": ("failed", "e2", 2), "c": ("pending", None, 1), "d": ("dead-letter", "z", 3)}


def test_gates_fail_without_a_metric(spark):
    metrics = spark.createDataFrame([("x", 1.0), ("y", 5.0)], "metric string, value double")
    limits = spark.createDataFrame([("x", 0.0, 2.0), ("y", None, 2.0), ("z", 0.0, None)], "metric string, lower double, upper double")
    assert {r.metric: r.passed for r in quality.gates(metrics, limits).collect()} == {"x": True, "y": False, "z": False}
