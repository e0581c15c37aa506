import json

from pyspark.sql import functions as F

from postings.operators import contract, model_outputs, nested

DEEP = {
    "n": 5, "trace": {"id": 9}, "x": {"id": 7}, "list": [[["deep"]]],
    "payload": {"job": {"Description": "<p>long &amp; text</p> ✨", "detail": {"requirements": ["bonus", "needs bonus and much more text than that", "at least 3 years"], "tags": [{"name": "SQL"}, {"name": "sql"}, "Go", "x" * 81, "y"]}}},
}


def rows_of(spark, *values):
    return spark.createDataFrame([(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)], "k long, j string")


def walk(value, names=()):
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in walk(v, (*names, k))]
    if isinstance(value, list):
        return [x for v in value for x in walk(v, names)]
    return [(names, value)]


def test_scalars_at_any_depth(spark):
    df = rows_of(spark, DEEP, None, "not json", [1, "a", [None, True]], '"top"', {"a": {"b": {"c": {"d": {"e": {"f": "six"}}}}}}, {})
    got = {}
    for r in nested.scalars(df, ["k"], "j").collect():
        got.setdefault(r.k, []).append((tuple(r.names), r.value))
    assert sorted(got) == [0, 3, 4, 5]
    assert sorted(map(str, got[0])) == sorted(str((n, str(v))) for n, v in walk(DEEP))
    assert got[5] == [(("a", "b", "c", "d", "e", "f"), "six")] and got[4] == [((), "top")]
    assert nested.scalars(df.limit(0), ["k"], "j").isEmpty()


def test_evidence_by_families(spark):
    found = nested.evidence(rows_of(spark, DEEP, {"about": "Python, SQL or python"}), ["k"], "j")
    best = {r.k: r for r in nested.best_evidence(found, ["k"]).collect()}
    assert best[0].description == "long & text" and best[0].requirement == "at least 3 years" and best[0].skills == ["SQL", "Go"]
    assert best[1].requirement is None and best[1].skills == ["Python", "SQL"]


def test_logs_go_to_the_job_named_inside(spark):
    logs = rows_of(spark, DEEP, {"a": [{"b": {"job_id": " 3 "}}], "job": {"id": 99}}, {"query_id": {"id": 4}}, None, {"id": "unknown"}, {"id": ""})
    got = {r.k: r.id for r in nested.attributed(logs, ["k"], "j", ("id", "job_id"), spark.range(8), "id").collect()}
    assert got == {0: 7, 1: None, 2: None, 3: None, 4: None, 5: None}  # the outermost id of 1 is 99, which is no job


def output(**changes):
    base = {"source": {"source_url": "https://x/1"}, "title": "Senior Data Engineer", "company": {"name": "Acme"}, "status": "active"}
    return json.dumps({k: v for k, v in (base | changes).items() if v is not ...})


def test_outputs_are_merged_or_rejected_one_by_one(spark):
    raw = {"payload": {"job": {"description": "What the source says", "requirements": ["SQL and Python needed"], "skills": ["SQL"]}}}
    requests = [("b1", 0, "i0", "source_a", "detail", raw), ("b1", 1, "i1", "source_b", "list", {"id": 1}), ("b1", 2, "i2", "source_a", "list", {}), ("b1", 3, "i3", "source_a", "list", {}), ("b2", 0, "i4", "source_a", "list", {}), ("b2", 1, "i5", "source_a", "list", {}),
                ("b3", 0, "i6", "source_a", "detail", {}), ("b3", 1, "i7", "source_a", "detail", {})]
    outputs = [("b1", 0, "i0", output(), None), ("b1", 1, "i1", output(location={"city": "Singapore"}), None), ("b1", 2, "i2", "not json", None), ("b1", 3, "i3", None, "timeout"), ("b2", 0, "i5", output(), None), ("b2", 1, "i4", output(), None),
               ("b3", 0, "i6", output(extra=1, salary={"min_amount": -5, "currency": "RUPIAH"}, status="open", title=" "), None),
               ("b3", 1, "i7", output(description="- one\n- two", requirements="3 years", skills=["Go", " "], work_type="Remote", employment_types=["Part Time"], experience_level="lead", salary={"min_amount": 9, "max_amount": 5}, source={"source_url": "u", "external_apply_url": "a"}), None)]
    q = spark.createDataFrame([(*r[:5], json.dumps(r[5])) for r in requests], "batch_id string, position int, item_id string, source string, endpoint string, raw string").withColumn("scraped_at", F.timestamp_seconds(F.lit(0)))
    o = spark.createDataFrame(outputs, "batch_id string, position int, item_id string, output string, error string")
    fields, rejected = model_outputs.merged_fields(q, o)
    got = {}
    for r in fields.collect():
        got.setdefault(r.item_id, {})[r.field] = (r.value, r.origin)
    assert {r.item_id: r.reasons for r in rejected.collect()} == {
        "i2": ["not_an_object"], "i3": ["model_error", "not_an_object"], "i4": ["item_order_mismatch"], "i5": ["item_order_mismatch"],
        "i6": ["unknown_key", "missing_title", "negative_amount", "bad_currency", "bad_status"],
    }
    assert set(got) == {"i0", "i1", "i7"}
    assert got["i0"]["description"] == ("What the source says", "evidence") and got["i0"]["requirements"] == ("SQL and Python needed", "evidence") and got["i0"]["skills"] == ("SQL", "evidence")
    assert got["i0"]["work_type"] == ("onsite", "default") and got["i0"]["experience_level"] == ("senior", "derived") and got["i0"]["country"] == ("Indonesia", "default") and got["i0"]["external_apply_url"] == ("https://x/1", "default")
    assert got["i1"]["description"][1] == "derived" and "listing-level data" in got["i1"]["description"][0] and "country" not in got["i1"] and "requirements" not in got["i1"]
    assert got["i7"]["description"] == ("<ul><li>one</li><li>two</li></ul>", "model") and got["i7"]["skills"] == ("Go", "model") and got["i7"]["external_apply_url"] == ("a", "model")
    assert (got["i7"]["salary_min"][0], got["i7"]["salary_max"][0]) == ("5", "9") and got["i7"]["employment_type"] == ("part_time", "model") and got["i7"]["last_seen_at"][1] == "run"


JOB = {c: "string" for c in contract.JOB.split(", ")} | {"skills": "array<string>", "is_remote": "boolean", "salary_min": "long", "salary_max": "long", "posted_at": "timestamp", "source_updated_at": "timestamp", "last_seen_at": "timestamp"}


def jobs_of(spark, *changes):
    base = dict(source=" Source_A ", external_id="e", title="Junior  Analyst", company="Acme", source_url="https://x", status="active", skills=["SQL / Go"], salary_min=0, salary_max=5000, description="plain words of a job")
    rows = [json.dumps({"id": i, "last_seen_at": "2024-01-01T00:00:00Z"} | base | c) for i, c in enumerate(changes)]
    schema = "id long, " + ", ".join(f"{c} {t}" for c, t in JOB.items())
    return spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", schema).alias("r")).select("r.*")


def test_payload_fields_and_rules(spark):
    jobs = jobs_of(
        spark, {}, {"title": " "}, {"salary_min": 9, "salary_max": 3, "company": "c" * 181}, {"salary_min": 0, "salary_max": 0, "salary_display": "Rp 0 / month", "work_type": "Work-From-Home", "employment_type": "part time"},
        {"salary_min": None, "salary_max": None, "salary_display": "competitive, yearly", "source": "source_b", "description": None, "title": "Lead Chef", "location_display": "Bandung, West Java"}, {"last_seen_at": None, "salary_currency": "RUPIAH"},
    )
    fields = contract.payload_fields(jobs, ["id"], ("source_b",))
    f = {r.id: r for r in fields.collect()}
    assert (f[0].source, f[0].title, f[0].apply_url, f[0].work_type, f[0].employment_type, f[0].experience_level) == ("source_a", "Junior Analyst", "https://x", "ONSITE", "FULL_TIME", "JUNIOR")
    assert (f[0].salary_min, f[0].salary_max, f[0].salary_display, f[0].description, f[0].status) == (None, 5000, "IDR 5,000 / month", "<p>plain words of a job</p>", "ACTIVE")
    assert (f[3].salary_min, f[3].salary_max, f[3].salary_display, f[3].employment_type) == (None, None, "Not specified", "PART_TIME")
    assert f[4].salary_display == "competitive, yearly" and f[4].salary_period == "YEARLY" and f[4].experience_level == "LEAD" and f[4].city == "Bandung" and "full details are unavailable" in f[4].description
    skills = spark.createDataFrame([(0, 1, "SQL, sql and Go", 0.5, "s"), (0, 2, "soft skills", 0.5, "s"), (0, 3, "go", 0.9, "s"), (3, 1, "Rust", 1.5, "s"), (77, 1, "Lost", 0.1, "s"), (None, 1, "Lost", 0.1, "s")] + [(4, i, f"Skill {chr(97 + i // 26)}{chr(97 + i % 26)} tool", 0.1, "s") for i in range(101)], "job long, at int, value string, confidence double, origin string")
    wanted = spark.createDataFrame([(0, 1, "skill", "Masters of SQL queries", "high", 0.4, "s"), (0, 2, "SKILL", "masters of  SQL queries", None, 0.4, "s"), (0, 3, "other", "bonus and THR", None, 0.1, "s"), (1, 1, "magic", "anything at all", None, 0.1, "s"), (5, 1, "OTHER", "works in teams daily", "urgent", 0.1, "s")], "job long, at int, type string, value string, priority string, confidence double, origin string")
    lists, bad = contract.job_requirements(wanted, "job", ["at"])
    valid, rejected = contract.consumer_payloads(fields, ["id"], contract.job_skills(skills, "job", ["at"]), lists, bad, "job")
    got = {r.id: r for r in valid.collect()}
    assert set(got) == {0} and [x.name for x in got[0].skills] == ["SQL", "Go"] and [(x.type, x.value, x.priority) for x in got[0].requirements] == [("SKILL", "Masters of SQL queries", "HIGH")]
    assert {r.id: r.reasons for r in rejected.collect()} == {1: ["missing_title", "bad_requirement_type"], 2: ["company_too_long", "salary_reversed"], 3: ["skills_confidence"], 4: ["too_many_skills"], 5: ["missing_last_seen_at", "bad_currency", "bad_priority"]}
    body = json.loads(contract.payload_json(valid, ["id"]).first().payload)
    assert body["jobListing"]["salaryMax"] == 5000 and "salaryMin" not in body["jobListing"] and body["sourcePlatform"]["slug"] == "source_a" and len(body["skills"]) == 2 and "ingestionRun" not in body
    assert {(r.job, r.n) for r in contract.orphan_relations(skills, "job", jobs, "id", "skill").collect()} == {(77, 1), (None, 1)}


def test_semantic_quality(spark):
    from postings.operators import semantic as s

    texts = [("Uang THR/bonus", True, False), ("bonuses", False, False), ("Gaji pokok, 5jt", True, False), (None, False, False), ("", False, False), ("Cookie: a=b", False, True), ("Authorization: bearer x", False, True), ("postgresql://h/db", False, True), ("a plain text", False, False), ("https://u:p@host/x", False, True)]
    got = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "k long, t string").select("k", s.is_noisy(F.col("t")), s.is_sensitive(F.col("t")), s.ensure_display(F.col("t"))).collect()
    assert [(r[1], r[2]) for r in sorted(got)] == [(n, x) for _, n, x in texts]
    shown = spark.createDataFrame([(0, "<p onclick='x'>a</p><script>b</script>"), (1, "- a\n- b"), (2, "a < b"), (3, None)], "k long, t string").select("k", s.ensure_display(F.col("t")).alias("d"))
    assert dict(shown.collect()) == {0: "<p>a</p>", 1: "<ul><li>a</li><li>b</li></ul>", 2: "<p>a &lt; b</p>", 3: None}
    pages = rows_of(spark, {"data": {"docs": [{}, {}], "page": 0, "limit": "9", "totalDocs": -1, "totalPages": 4}}, {"data": {"docs": []}}, {"data": {}}, None, "bad").select(F.col("k").alias("page_id"), F.col("j").alias("payload"))
    assert sorted(map(tuple, s.page_totals(pages, "source_a").collect())) == [(0, 1, 2, 2, 4, 2), (1, 1, 1, 0, 0, 0)]


def test_levels_are_opened_in_one_pass_and_written_once(spark, monkeypatch):
    written = []
    write = nested.materialize
    monkeypatch.setattr(nested, "materialize", lambda df, name: written.append(name) or write(df, name))
    found = nested.evidence(rows_of(spark, DEEP, {"SKILLS": {"about": "both kinds"}}, {}, []), ["k"], "j")
    assert len(written) == 1
    assert sorted((r.family, r.text) for r in found.where("k = 1").collect()) == [("description", "both kinds"), ("skill", "both kinds")]
    assert nested.scalars(rows_of(spark, {"a": {"b": {"c": {"d": {"e": {"f": [{"g": ["low", {}]}]}}}}}}), ["k"], "j").count() == 1


def test_relations_are_dealt_by_job_once(spark):
    rows = [(0, 2, "go / SQL", "skill", " Works with  SQL daily ", "s"), (0, 1, "SQL", "SKILL", "works with sql daily", "s"), (0, 3, "SQL", "other", "works with sql daily", "s"), (0, 9, "SQL", "SKILL", "works with sql daily", "s"), (1, 1, "soft skills", "other", "bonus", "s"), (2, 1, "Rust", None, "leads a large team", "s")]
    rows = spark.createDataFrame(rows, "job long, at int, skill string, type string, said string, origin string").withColumns({"confidence": F.col("at") / 10, "priority": F.lit("low")})
    made = rows.withColumns({"names": contract.skill_names(F.col("skill")), "value": contract.requirement_value(F.col("said"))})
    both = contract.relation_lists(made, "job", ["at"])
    got = {r.job: ([tuple(x) for x in r.skills], [tuple(x) for x in r.requirements], r.refused) for r in both.collect()}
    wanted = [("SKILL", "works with sql daily", "LOW", 0.1, "s"), ("OTHER", "works with sql daily", "LOW", 0.3, "s")]
    assert got == {0: ([("SQL", 0.1, "s"), ("go", 0.2, "s")], wanted, None), 1: ([], [], None), 2: ([("Rust", 0.1, "s")], [], "bad_requirement_type")}
    assert contract.job_requirements(rows.withColumn("value", F.col("said")), "job", ["at"])[1].collect() == [(2, "bad_requirement_type")]
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(both.select("*")) == 1 and shuffles(contract.job_skills(rows.withColumn("value", F.col("skill")), "job", ["at"])) == 1


def test_payload_queries_read_lines_once(spark):
    import __spark_entry__ as entry

    for name in ("consumer_payloads", "rejected_payloads"):
        plan = entry.queries()[name](spark, entry.SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem.parquet") == 1 and "posexplode" not in plan
