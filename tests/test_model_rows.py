import json

from pyspark.sql import functions as F

from postings.plans import model_rows as m


def test_a_bare_listing_has_every_column_and_no_null_text(spark):
    base = spark.createDataFrame([('{"job_id": "1"}',), ('{"job_id": "2", "title": " Head  Chef ", "salary_min": 0, "salary_max": 9, "status": "closed", "stale": false, "completeness": 80, "fit_quality": 70, "requirements": [{"type": "SKILL", "value": "Go", "priority": "HIGH", "sort_order": 1}, {"type": "OTHER", "value": "x", "priority": "", "sort_order": 2}], "skills": [{"name": "Go", "slug": "go", "category": "c"}, {"name": "Rust", "slug": "rust", "category": "b"}]}',)], "j string")
    base = base.select(F.from_json("j", m.BASE).alias("r")).select("r.*")
    got = m.model_rows(base, F.lit("2024-01-31 00:00:00").cast("timestamp"))
    assert len(got.columns) == len(set(got.columns)) == 110
    bare, full = got.orderBy("job_id").collect()
    assert not [c for c, kind in got.dtypes if kind == "string" and bare[c] is None]
    assert all(json.loads(full[c]) is not None for c in got.columns if c.endswith("_json"))
    assert (bare.has_minimum_model_context, bare.model_input_token_estimate, bare.requirements_json, bare.skill_source_quality) == (0, 0, "[]", "fallback")
    assert json.loads(full.required_skill_keywords_json) == ["Go"] and json.loads(full.optional_skill_keywords_json) == ["Rust"] and json.loads(full.ats_keywords_json) == ["Go", "Rust"]
    assert full.model_input_salary_context == "9" and full.weak_label_freshness_signal == "expired" and full.weak_label_job_quality_tier == "A" and full.weak_label_apply_priority == "high"
    assert json.loads(full.requirements_type_distribution_json) == {"SKILL": 1, "EXPERIENCE": 0, "EDUCATION": 0, "RESPONSIBILITY": 0, "OTHER": 1} and full.requirement_classification_quality_score == 0.5
    assert json.loads(full.job_fit_feature_vector_json) == [70, 1, 2] and json.loads(full.skills_json)[0] == {"category": "c", "confidence": None, "name": "Go", "slug": "go"}
    assert m.model_rows(base.limit(0), F.current_timestamp()).isEmpty()


def test_lists_with_nulls_unknown_types_and_repeats_keep_order_and_count(spark):
    kinds = [("SKILL", "b", "HIGH"), None, (None, None, None), ("OTHER", "x", ""), ("SKILL", "a", "LOW"), ("zzz", "q", "HIGH")] + [("SKILL", f"s{i}", "LOW") for i in range(30)]
    reqs = [k and {"type": k[0], "value": k[1], "priority": k[2], "sort_order": 9} for k in kinds]
    skills = [{"name": "a", "slug": "a", "category": "z"}, None, {"name": "k", "slug": "k", "category": "c"}, {"name": "k", "slug": "k", "category": "c"}]
    base = spark.createDataFrame([(json.dumps({"job_id": "1", "title": "Ab abc\tDEF9 x", "description": "<b>a\u00a0b</b>  c\u2028d", "requirements": reqs, "skills": skills}),)], "j string")
    row = m.model_rows(base.select(F.from_json("j", m.BASE).alias("r")).select("r.*"), F.current_timestamp()).first()
    wanted = ["b", "a"] + [f"s{i}" for i in range(30)]
    assert json.loads(row.required_skill_keywords_json) == wanted and [r["value"] for r in json.loads(row.requirements_skill_json)] == wanted
    assert json.loads(row.skill_gap_core_skills_json) == wanted[:20] and json.loads(row.requirements_education_json) == []
    assert [r["value"] for r in json.loads(row.requirements_json)][:6] == ["b", None, None, "x", "a", "q"] and list(json.loads(row.requirements_json)[0]) == ["priority", "sort_order", "type", "value"]
    assert json.loads(row.requirements_type_distribution_json)["SKILL"] == 32 and json.loads(row.requirements_priority_distribution_json) == {"HIGH": 2, "LOW": 31, "MEDIUM": 0}
    assert json.loads(row.important_requirement_highlights_json) == ["b", "q"] and json.loads(row.skill_categories_json) == ["c", "z", None]
    assert json.loads(row.optional_skill_keywords_json) == ["k", "k"] and json.loads(row.weak_label_role_keywords_json) == ["abc", "def9"]
    assert row.model_input_description_plaintext == "a b c d"


def test_wide_columns_are_not_worked_out_in_one_task_a_core(spark):
    import os

    from postings.queries import QUERIES

    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["model_rows"](spark, f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.001")
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_orderkey" in plan and "REPARTITION_BY_NUM" in plan
