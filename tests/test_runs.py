from postings.operators import reports, runs
from pyspark.sql import functions as F


def test_columns(spark):
    df = spark.createDataFrame([("go, Go,, rust ", "2024-01-31T07:00:00", 503)], "k string, t string, s int")
    errors = F.array(*(F.lit(f"e{i}") for i in range(12)))
    r = df.select(
        runs.keyword_list(F.col("k")).alias("k"), runs.since(F.col("t"), "Asia/Jakarta").cast("string").alias("local"), runs.since(F.concat("t", F.lit("+02:00")), "Asia/Jakarta").cast("string").alias("offset"),
        runs.response_summary(F.col("s"), errors).alias("r"), runs.response_summary(F.lit(None).cast("int"), F.lit(None).cast("array<string>")).alias("none"), runs.error_class(F.lit("sync")).alias("e"),
    ).first()
    assert r.k == ["go", "rust"] and r.local == "2024-01-31 00:00:00" and r.offset == "2024-01-31 05:00:00"
    assert (r.r.status_class, r.r.n_errors, len(r.r.errors)) == ("5xx", 12, 10) and (r.none.status_class, r.none.n_errors) == ("transport", 0)
    assert tuple(r.e) == ("sync", "SYNC_ERROR", True)


def test_tables(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", "y", 3), ("b", "x", 4)], "s string, id string, n int")
    first, dropped = runs.dedup_pages(rows, ["s"], "id", ["n"])
    assert sorted(map(tuple, first.collect())) == [("a", "x", 1), ("a", "y", 3), ("b", "x", 4)] and dict(dropped.collect()) == {"a": 1, "b": 0}
    kept, cut = runs.truncated(rows, [F.desc_nulls_last("n")], 3)
    assert [r.n for r in kept.collect()] == [4, 3, 2] and cut.first()[0] == 1
    assert tuple(runs.missing_ids(rows, rows.where("n > 2"), "n").first()) == (2, [1, 2])
    ledger = runs.handoff(rows.select("s", "id").limit(0), rows, ["s", "id"])
    assert ledger.count() == 3 and runs.handoff(ledger, rows, ["s", "id"]).count() == 0
    held = spark.createDataFrame([("a", 2, None), ("a", 1, None), ("b", 3, 1)], "source string, n int, resolved_at int")
    assert [r.n for r in runs.open_quarantine(held, "a", ["n"]).collect()] == [1, 2] and runs.open_quarantine(held, None, ["n"]).count() == 2
    stages = spark.createDataFrame([("r", "completed"), ("r", "partial"), ("q", None)], "run string, s string")
    assert dict(runs.worst_status(stages, ["run"], F.col("s")).collect()) == {"r": "partial", "q": "completed"}
    ranked = reports.failure_summary(rows.withColumn("bad", F.lit(True)), F.col("bad"), [F.col("id")]).collect()
    assert [(r.id, r.n) for r in ranked] == [("x", 3), ("y", 1)]


def test_redacted_keys(spark):
    from postings.functions import json

    text = '{"bearer":"a","credential":"b","visitorId":"c","device":"d","database_url":"e","name":"f"}'
    assert spark.range(1).select(json.redact_keys(F.lit(text)).alias("t")).first().t.count("<redacted>") == 5
