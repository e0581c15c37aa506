import json

from pyspark.sql import functions as F

from postings.operators import keyed
from postings.sources import captures, csv_sink
from postings.streaming import incremental, upserts


def test_pages_or_rejects(spark):
    pages = [
        (1, json.dumps({"data": {"docs": [{"id": "x", "role": "r"}, {"id": 5}, {"id": " "}, {}]}})),
        (2, "not json"),
        (3, json.dumps({"data": {}})),
        (4, None),
        (5, json.dumps({"data": {"docs": []}})),
    ]
    rows, rejects = captures.parse_pages(spark.createDataFrame(pages, "page_id long, payload string"), "source_a")
    assert [(r.page_id, r.position, r.external_id, json.loads(r.payload)) for r in rows.collect()] == [(1, 0, "x", {"id": "x", "role": "r"})]
    assert sorted((r.page_id, r.position, r.reason) for r in rejects.collect() if r.position is not None) == [(1, 1, "missing_id"), (1, 2, "missing_id"), (1, 3, "missing_id")]
    assert {(r.page_id, r.reason) for r in rejects.collect() if r.position is None} == {(2, "not_json"), (3, "missing_list"), (4, "not_json")}
    d = spark.createDataFrame([(1, '{"pageProps":{"jobs":[{"id":7},{"id":"8"},{"id":true}]}}')], "page_id long, payload string")
    assert [r.external_id for r in captures.parse_pages(d, "source_d")[0].collect()] == ["7", "8"]
    b = spark.createDataFrame([(1, '{"data":{"searchJobsV3":{"jobsInPage":[{"id":"1"}]}}}'), (2, '{"errors":[1],"data":{"searchJobsV3":{"jobsInPage":[],"hasMore":true}}}')], "page_id long, payload string")
    assert {r.reason for r in captures.parse_pages(b, "source_b")[1].collect()} == {"missing_flag", "source_errors"}
    e = spark.createDataFrame([(1, '{"data":{"vacanciesV4":{"list":[{"id":"1","slug":"s","positionName":"p","company":{"name":"c"}},{"id":"2","slug":""},{"id":"3","slug":"s","positionName":"p"}]}}}')], "page_id long, payload string")
    rows, rejects = captures.parse_pages(e, "source_e")
    assert rows.count() == 1 and [r.reason for r in rejects.collect()] == ["missing_field"] * 2


def test_balanced_objects(spark):
    rows = [(1, 'x = {"a": "}{", "b": {"c": "\\"}"}}; rest'), (2, "nothing"), (3, None), (4, "x = {open")]
    got = dict(captures.embedded_json(spark.createDataFrame(rows, "k long, html string"), "html", "x =", "k").collect())
    assert json.loads(got[1]) == {"a": "}{", "b": {"c": '"}'}} and got[2] is None and got[3] is None and got[4] is None


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, True, None, 'a "b", c'), (2, False, "x", "")], "id long, flag boolean, note string, text string")
    csv_sink.write_csv(df, str(tmp_path / "out"), ["id", "flag", "note", "missing", "text"])
    got = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert got.columns == ["id", "flag", "note", "missing", "text"]
    assert sorted((r.id, r.flag, r.text) for r in got.collect()) == [("1", "1", 'a "b", c'), ("2", "0", None)]
    wide = csv_sink.guard_width(df, ["text"], 3, "id")
    try:
        wide.collect()
        raise AssertionError("a row too wide must fail")
    except Exception as e:
        assert "row too wide: 1" in str(e)


def test_streams_equal_the_batch(spark, tmp_path):
    events = spark.createDataFrame([(i % 7, i, (i + 48) * 3600) for i in range(200)], "k long, id long, s long").withColumn("at", F.timestamp_seconds("s"))
    for n in range(4):  # four files, the last with late duplicates
        events.where(f"id % 4 = {n} or (id < 10 and {n} = 3)").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = incremental.files(spark, str(tmp_path / "in"), "k long, id long, s long, at timestamp", 1)
    for _ in range(2):  # a second run finds nothing new
        upserts.upsert_stream(stream, str(tmp_path / "t"), str(tmp_path / "c"), ["k"], ["s", "id"]).awaitTermination()
        got = sorted(map(tuple, upserts.current(spark, str(tmp_path / "t")).select("k", "id").collect()))
        assert got == sorted(map(tuple, keyed.latest_by(events, ["k"], ["s", "id"]).select("k", "id").collect()))
    once = incremental.first_observations(stream, ["id"], "at", "30 days")
    q = once.writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.sql("select id from once").collect()) == list(range(200))
    q = incremental.daily_counts(stream, "at", "k", "30 days").writeStream.outputMode("complete").format("memory").queryName("daily").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from daily").first()[0] == 200 + 8  # ids below 10 come twice but for 3 and 7
