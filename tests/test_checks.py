from pyspark.sql import functions as F

from postings.operators import checks


def test_strict_invariants(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    stages = [("a", s, "completed", None, 0, "r") for s in checks.STAGES] + [("b", "enrich", "failed", None, 0, None), ("b", "sync", "completed", None, 0, None), ("b", "notify", "completed", None, 0, None)]
    ids = "run string, id int"
    found = checks.strict_invariants(
        df(stages, "run string, stage string, status string, error string, skipped int, reason string"), df([("a", 1), ("b", 1), ("b", 2)], ids), df([("a", 1), ("b", 1)], ids),
        df([("a", 1, True), ("b", 1, False)], ids + ", eligible boolean"), df([("b", False)], "run string, safe boolean"), df([], "run string, ok boolean"), df([("a", True)], "run string, ok boolean"),
        df([], "run string, ok boolean"),
    )
    got = {(r.run, r.name): r.violations for r in found.collect()}
    assert len(got) == 18 and not any(n for (run, _), n in got.items() if run == "a")
    assert {name: n for (run, name), n in got.items() if run == "b"} == {
        "stageRowsPresent": 2, "normalizeCountInvariant": 0, "normalizeHasEligibilityDecision": 1, "normalizeRespectsEligibilityDecision": 1, "quarantineSafeErrorEvidence": 1,
        "enrichFailureHasAiEvidence": 1, "syncZeroSentHasReason": 1, "notifyZeroSentHasReason": 1, "failedStageHasErrorEvidence": 1,
    }


def test_texts(spark):
    r = spark.range(1).select(
        checks.combined(F.lit("a b"), F.lit("b")).alias("held"), checks.combined(F.lit(None).cast("string"), F.lit("b")).alias("one"), checks.combined(F.lit("a"), F.lit("b")).alias("both"),
        checks.without_headings(F.lit("TUGAS UTAMA\nCook!\n\nmemasak\nMINIMAL S1"), F.lit("cook")).alias("lines"), checks.without_headings(F.lit("A"), F.lit(None).cast("string")).alias("none"),
    ).first()
    assert tuple(r) == ("a b", "b", "a\n\nb", "memasak\nMINIMAL S1", None)
    texts = spark.createDataFrame([("k", "long bonus", 1), ("k", "mid", 2), ("k", "abc", 1), ("j", "bonus", 1), ("i", None, 1)], "k string, t string, n int")
    assert dict(checks.best_text(texts, ["k"], "t", ["n"], F.col("t").contains("bonus")).collect()) == {"k": "abc", "j": "bonus"}


def test_embedded(spark):
    from postings.sources import embedded

    assert embedded.first_value('x [bad RESPONSE {"a": [1, "}"]} tail') == '{"a": [1, "}"]}' and embedded.first_value("none {") is None and embedded.first_value(None) is None
    pages = spark.createDataFrame([(1, f"{embedded.PAGE_DATA}{{oops</script>"), (2, None), (3, f'{embedded.PAGE_DATA} [1] </script></script>'), (4, "")], "id int, h string")
    rows = {r.id: (r.p.json, r.p.reason, r.f) for r in pages.select("id", embedded.script_json(F.col("h")).alias("p"), embedded.first_json(F.col("h")).alias("f")).collect()}
    assert rows == {1: (None, "not_json", None), 2: (None, "missing", None), 3: ("[1]", None, "[1]"), 4: (None, "missing", None)}
