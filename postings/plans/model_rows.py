"""Model rows: contexts, labels, JSON lists, feature vectors, weak labels and evidence of each listing, under one typed header."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import dates, identity, roles, salary, text, wording
from postings.plans import dataset

# fixed values: versions, tasks that can't be served, types, priorities, steps, weights and texts of the contract
VERSION = "1.0.0"
UNSUPPORTED = ("user_profile_embedding", "cv_raw_text_scoring", "personalized_outcome_prediction")
TYPES = ("SKILL", "EXPERIENCE", "EDUCATION", "RESPONSIBILITY", "OTHER")
PRIORITIES = ("HIGH", "MEDIUM", "LOW")
STEPS = {
    "high": ["apply_now", "highlight_relevant_skills", "tailor_cv_keywords"],
    "medium": ["close_skill_gap", "improve_requirement_alignment", "apply_next"],
    "low": ["build_core_skills", "search_similar_roles", "recheck_later"],
}
WEIGHTS = {"skills": 0.45, "experience": 0.25, "preferences": 0.20, "freshness": 0.10}
EXPECTED = {
    "job_fit_scoring": "score, readiness_level, explainable_breakdown", "skill_gap_analysis": "missing_skills, priority_levels, actionable_plan",
    "career_strategy_recommendation": "apply_priority, next_steps", "cv_analyzer_job_context": "keywords, experience_expectation, ats_hints",
}
RUBRIC = {
    "job_fit_scoring": {"relevance": 0.4, "explainability": 0.3, "consistency": 0.3}, "skill_gap_analysis": {"precision": 0.4, "coverage": 0.3, "actionability": 0.3},
    "career_strategy_recommendation": {"clarity": 0.4, "evidence": 0.3, "safety": 0.3}, "cv_analyzer_job_context": {"signal_quality": 0.5, "completeness": 0.5},
}
HOLDOUT, LOW_CONFIDENCE = "source_e", 55
CLOSED = ("EXPIRED", "CLOSED", "HIDDEN")

#: What a row is made of: the listing, its aggregates and signals, and its children in order.
BASE = (
    "job_id string, external_job_id string, source string, company_id string, company_name string, title string, normalized_title string, category string, description string, requirement_summary string, "
    "work_type string, employment_type string, experience_level string, city string, province string, location_display string, salary_display string, salary_min bigint, salary_max bigint, salary_currency string, "
    "salary_period string, status string, source_posted_at timestamp, last_seen_at timestamp, completeness int, fit_quality int, detail_readiness int, gap_coverage int, stale boolean, confidence_avg double, "
    "n_interview bigint, n_accepted bigint, n_rejected bigint, model_name string, n_failed bigint, "
    "requirements array<struct<type: string, value: string, priority: string, sort_order: int>>, skills array<struct<name: string, slug: string, category: string>>"
)


def fixed_json(value: object) -> Column:
    return F.lit(json.dumps(value, separators=(",", ":"), sort_keys=True))


def _json(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def joined(separator: str, *parts: Column) -> Column:
    """Parts that aren't empty, between separators."""
    return F.concat_ws(separator, *(F.when(x != "", x) for x in parts))


def ordered(c: Column) -> Column:
    """Distinct elements in order, null last."""
    s = F.sort_array(F.array_distinct(c))
    return F.when((F.size(s) > 0) & F.get(s, F.lit(0)).isNull(), F.concat(F.slice(s, 2, F.size(s)), F.array(F.lit(None).cast("string")))).otherwise(s)


def count_of(values: str, value: str) -> Column:
    return F.size(values) - F.size(F.array_remove(values, value))


def prepared(base: DataFrame) -> DataFrame:
    """Base rows with everything that several columns use, each once, in layers.

    Lambdas, and all that stands in their arguments, are interpreted, so lists are taken apart by
    functions that are compiled: requirements are sorted by type once, and a type's are a slice.
    Every wide layer keeps one lambda: it is then compiled as a projection in many methods, where
    lambda-free layers would become one method too large for the JVM to compile.
    """
    words = [c for c, kind in base.dtypes if kind == "string"]
    df = base.select(*(F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) if c in words else F.col(c) for c in base.columns))
    empty = {c: F.coalesce(F.col(c), F.array().cast(base.schema[c].dataType)) for c in ("requirements", "skills")}
    df = df.withColumns(empty | {c: F.upper(F.col(c)) for c in ("work_type", "employment_type", "experience_level", "salary_period", "status")})
    r, s = F.col("requirements"), F.col("skills")
    df = df.withColumns({
        "types": r["type"], "number": F.transform("requirements", lambda r, i: i), "priorities": r["priority"], "values": r["value"], "names": s["name"], "slugs": s["slug"], "categories": s["category"],
        "items": F.arrays_zip(r["priority"], r["sort_order"], r["type"], r["value"]).cast("array<struct<priority: string, sort_order: int, type: string, value: string>>"),
        "plain_description": text.strip_tags(F.col("description")), "plain_summary": text.strip_tags(F.col("requirement_summary")),
        "place": joined(" | ", F.col("location_display"), F.col("province"), F.col("city")),
        "pay": joined(" | ", F.col("salary_display"), F.coalesce(F.nullif("salary_min", F.lit(0)).cast("string"), F.lit("")), F.coalesce(F.nullif("salary_max", F.lit(0)).cast("string"), F.lit("")), F.col("salary_currency"), F.col("salary_period")),
        "group_key": F.concat_ws("|", F.lower("source"), F.lower("company_name"), F.lower(F.when(F.col("normalized_title") != "", F.col("normalized_title")).otherwise(F.col("title")))),
    })
    df = df.withColumn("by_type", F.sort_array(F.arrays_zip("types", "number", "items").cast(f"array<struct<type: string, number: int, item: {df.schema['items'].dataType.elementType.simpleString()}>>")))
    of_type = {t.lower(): F.slice(F.col("by_type")["item"], F.greatest(F.lit(1), F.array_position(F.col("by_type")["type"], t)).cast("int"), count_of("types", t)) for t in TYPES}
    df = df.withColumns({
        **{f"{t}_items": x for t, x in of_type.items()}, **{t: x["value"] for t, x in of_type.items()}, "high": F.filter("requirements", lambda r: r["priority"] == "HIGH")["value"],
        "value_text": F.array_join("values", " ; "), "name_text": F.array_join("names", " ; "),
        "priority": F.when(F.col("stale"), "low").when(F.col("fit_quality") >= 70, "high").otherwise("medium"),
    })
    # each name is looked up in the required ones: the contract allows a listing 100 relations
    df = df.withColumns({
        "optional": F.filter("names", lambda n: ~F.array_contains("skill", n)),
        "context": joined("\n", *(F.col(c) for c in ("title", "normalized_title", "company_name", "category", "place", "pay", "plain_description", "plain_summary", "value_text", "name_text"))),
    })
    return df.withColumns({f"{c}_json": _json(F.col(c)) for c in ("values", "names", "slugs", "skill", "optional", "experience")})


def columns() -> dict[str, Column]:
    """The header: name to what it holds, over ``prepared`` rows. Texts are never null; numbers are where nothing is known."""
    c, flag = F.col, lambda x: F.coalesce(x, F.lit(False)).cast("int")
    first = lambda name: F.coalesce(F.get(name, F.lit(0)), F.lit(""))
    few = lambda name, n: F.when(F.size(name) <= n, c(f"{name}_json")).otherwise(_json(F.slice(name, 1, n)))
    share = F.col("completeness") / 100
    scores = dataset.readiness(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)), F.size("requirements") > 0, F.size("skills") > 0, F.col("description") != "")
    by_name = dict(sorted(scores.items()))
    blocked = {t: F.when(s >= dataset.READY, F.array().cast("array<string>")).otherwise(F.array(F.lit("insufficient_job_context"))) for t, s in by_name.items()}
    reqs = lambda t: _json(c(f"{t.lower()}_items"))
    counted = lambda field, keys: _json(F.struct(*(count_of(field, k).alias(k) for k in sorted(keys))))
    skill_rows = F.arrays_zip("categories", F.array_repeat(F.lit(None).cast("double"), F.size("skills")), "names", "slugs").cast("array<struct<category: string, confidence: double, name: string, slug: string>>")
    n_required, n_skills = F.size("skill"), F.size("names")
    rank = c("detail_readiness") + c("fit_quality") + c("n_interview") * 5
    prefer = F.struct(c("employment_type"), c("experience_level"), c("location_display").alias("location"), c("salary_display"), c("work_type"))
    steps = {k: fixed_json(v) for k, v in STEPS.items()}
    return {
        "job_id": c("job_id"), "external_job_id": c("external_job_id"), "source_platform_slug": c("source"), "company_id": c("company_id"), "company_name": c("company_name"),
        "dataset_version": F.lit(VERSION), "dataset_schema_version": F.lit(VERSION), "model_split": identity.split_of(c("group_key")), "split_group_key": c("group_key"),
        "is_holdout_source": flag(c("source") == HOLDOUT), "is_low_confidence_label": flag(c("completeness") < LOW_CONFIDENCE), "label_confidence_score": F.bround(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)), 4),
        "supported_model_tasks_json": fixed_json(list(dataset.TASKS)), "unsupported_model_tasks_json": fixed_json(UNSUPPORTED),
        "model_task_readiness_json": _json(F.struct(*(s.alias(t) for t, s in by_name.items()))), "model_task_blockers_json": _json(F.struct(*(b.alias(t) for t, b in blocked.items()))),
        "model_input_title": c("title"), "model_input_normalized_title": c("normalized_title"), "model_input_company_context": c("company_name"), "model_input_location_context": c("place"), "model_input_salary_context": c("pay"),
        "model_input_description_plaintext": c("plain_description"), "model_input_requirement_summary_plaintext": c("plain_summary"), "model_input_requirements_text": c("value_text"), "model_input_skills_text": c("name_text"),
        "model_input_full_context": c("context"), "model_input_short_context": joined(" | ", c("title"), c("company_name"), c("place")),
        "model_input_cv_compare_context": joined(" | ", c("title"), c("plain_summary"), F.array_join(F.slice("values", 1, 10), " ; "), F.array_join(F.slice("names", 1, 15), " ; ")),
        "model_input_career_copilot_context": joined(
            " | ", c("title"), c("company_name"), c("category"), F.when(F.size("values") > 0, F.concat(F.lit("Important requirements: "), F.array_join(F.slice("values", 1, 8), " ; "))).otherwise(""),
            F.when(n_skills > 0, F.concat(F.lit("Keywords: "), F.array_join(F.slice("names", 1, 12), " ; "))).otherwise(""),
        ),
        "label_work_type": c("work_type"), "label_employment_type": c("employment_type"), "label_experience_level": c("experience_level"), "label_category": c("category"),
        "label_role_family": roles.role_family(F.when(c("normalized_title") != "", c("normalized_title")).otherwise(c("title"))), "label_seniority_bucket": roles.seniority(c("experience_level")),
        "label_salary_bucket": salary.bucket(c("salary_min"), c("salary_max")), "label_location_city": c("city"), "label_location_province": c("province"), "label_is_remote_friendly": flag(c("work_type") == "REMOTE"),
        "label_is_entry_level_friendly": flag(c("experience_level").isin("ENTRY_LEVEL", "JUNIOR")), "label_is_tech_or_digital_role": flag(roles.is_tech(F.concat_ws(" ", c("title"), c("names")))),
        "label_job_search_rank_bucket": F.when(rank >= 170, "top").when(rank >= 120, "mid").otherwise("low"), "label_recommendation_candidate_tier": dataset.recommendation_tier(c("stale"), c("fit_quality")),
        "skills_json": _json(skill_rows), "skill_slugs_json": c("slugs_json"), "skill_names_json": c("names_json"), "skill_categories_json": _json(ordered(c("categories"))), "skill_count": n_skills,
        "skill_confidence_avg": c("confidence_avg"), "skill_source_quality": F.when(n_skills > 0, "explicit").otherwise("fallback"), "primary_skill_slug": first("slugs"), "primary_skill_category": first("categories"),
        "required_skill_keywords_json": c("skill_json"), "optional_skill_keywords_json": c("optional_json"), "skill_embedding_text": c("name_text"),
        "requirements_json": _json(c("items")), **{f"requirements_{t.lower()}_json": reqs(t) for t in TYPES}, "requirements_count_total": F.size("requirements"),
        "requirements_type_distribution_json": counted("types", TYPES), "requirements_priority_distribution_json": counted("priorities", PRIORITIES),
        "requirement_classification_quality_score": dataset.classified_quality(c("types"), c("priorities")),
        "requirement_keywords_json": few("values", 40), "ats_keywords_json": _json(F.slice(ordered(F.concat("names", "skill")), 1, 50)), "important_requirement_highlights_json": _json(F.slice("high", 1, 10)),
        "fit_context_skills_required_json": c("skill_json"), "fit_context_experience_requirements_json": c("experience_json"), "fit_context_education_requirements_json": _json(c("education")), "fit_context_responsibilities_json": _json(c("responsibility")),
        "fit_context_preferences_json": _json(prefer), "skill_gap_target_skills_json": c("slugs_json"), "skill_gap_core_skills_json": few("skill", 20), "skill_gap_optional_skills_json": few("optional", 20),
        "readiness_signal_level": c("priority"), "candidate_matching_weight_json": fixed_json(WEIGHTS), "job_fit_feature_vector_json": _json(F.array(c("fit_quality"), n_required, n_skills)),
        "preference_match_feature_vector_json": _json(F.array(*(flag(c(x) != "") for x in ("work_type", "location_display", "salary_display")))),
        "experience_match_feature_vector_json": _json(F.array(roles.seniority_number(c("experience_level")), n_required)), "skill_match_feature_vector_json": _json(F.array(n_skills, n_required, F.size(F.array_distinct("slugs")))),
        "skill_gap_feature_vector_json": _json(F.array(c("gap_coverage"), n_required, F.size("optional"))),
        "weak_label_apply_priority": c("priority"), "weak_label_job_quality_tier": F.when(c("completeness") >= 80, "A").when(c("completeness") >= LOW_CONFIDENCE, "B").otherwise("C"), "weak_label_market_salary_signal": salary.signal(c("salary_min"), c("salary_max")),
        "weak_label_freshness_signal": F.when(c("status").isin(*CLOSED), "expired").when(c("stale"), "stale").otherwise("fresh"),
        "weak_label_search_relevance_keywords_json": _json(text.keywords(c("title"), c("normalized_title"), c("category"), c("province"), c("city"))), "weak_label_role_keywords_json": _json(text.role_keywords(c("title"))),
        "weak_label_readiness_level": c("priority"), "weak_label_success_probability_bucket": F.when(c("n_accepted") > 0, "high").when((c("priority") == "high") & (c("n_rejected") == 0), "medium").otherwise("low"),
        "weak_label_actionable_next_steps_json": F.when(c("priority") == "high", steps["high"]).when(c("priority") == "medium", steps["medium"]).otherwise(steps["low"]),
        "text_quality_score": text.text_quality(c("plain_description"), c("plain_summary"), plain=True), "normalization_completeness_score": c("completeness"),
        "model_input_token_estimate": F.when(c("context") == "", 0).otherwise(text.token_estimate(c("context"))), "has_minimum_model_context": flag(c("context") != ""),
        "missing_model_context_fields_json": _json(wording.missing_context(c("title"), c("description"), c("values"), c("names"))),
        "source_posted_at": F.coalesce(dates.iso_z(c("source_posted_at")), F.lit("")), "last_seen_at": F.coalesce(dates.iso_z(c("last_seen_at")), F.lit("")), "status": c("status"),
        "ai_request_latest_model_name": c("model_name"), "ai_request_count_failed": F.coalesce("n_failed", F.lit(0)), "xai_skill_evidence_json": few("names", 15), "xai_experience_evidence_json": few("experience", 10),
        "xai_preference_evidence_json": _json(F.array(c("work_type"), c("location_display"), c("pay"))), "xai_requirement_evidence_json": few("values", 20), "xai_salary_location_evidence_json": _json(F.array(c("pay"), c("place"))),
        "evaluation_expected_outputs_json": fixed_json(EXPECTED), "evaluation_rubric_json": fixed_json(RUBRIC),
    }


def model_rows(base: DataFrame, exported_at: Column) -> DataFrame:
    """A model row a listing (``BASE`` columns): null texts are empty, null lists are empty lists, no shuffle."""
    made = columns()
    names = list(made)
    at = names.index("model_split")
    return prepared(base).select(*(made[n].alias(n) for n in names[:at]), dates.iso_z(exported_at).alias("dataset_exported_at"), *(made[n].alias(n) for n in names[at:]))


def queries(table: Callable) -> dict[str, tuple[Callable, str | None]]:
    def base(spark, sf_dir):
        """Orders as listings, their lines as requirements and skills; lines are put together before the join."""
        k, t = F.col("o_orderkey"), lambda n: table(spark, sf_dir, n)
        kind = F.when(F.col("l_quantity") < 5, "EDUCATION").when(F.col("l_quantity") > 45, "RESPONSIBILITY").when(F.col("l_returnflag") == "R", "SKILL").when(F.col("l_returnflag") == "A", "EXPERIENCE").otherwise("OTHER")
        place = F.struct(F.col("l_linenumber").cast("int").alias("n"), "l_partkey", "l_suppkey", "p_name", "p_type", kind.alias("kind"), F.when(F.col("l_quantity") > 25, "HIGH").otherwise("").alias("priority"))
        # by an explicit number, so that adaptive execution doesn't put the few bytes before the wide columns into as few tasks as there are cores
        lines = t("lineitem").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
        kids = lines.join(t("part"), F.col("p_partkey") == F.col("l_partkey")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(place)).alias("kids"), F.bround(F.avg(F.bround(F.col("l_discount") * 100).cast("long")), 4).alias("confidence_avg"))
        star = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
        star = star.join(kids, F.col("l_orderkey") == k, "left")
        pick = lambda i, *options: F.element_at(F.array(*map(F.lit, options)), (k % i + 1).cast("int"))
        return star.select(
            k.cast("string").alias("job_id"), F.concat(F.lit("e"), k).alias("external_job_id"), pick(3, "source_a", "source_b", "source_e").alias("source"), F.col("c_custkey").cast("string").alias("company_id"), F.col("c_name").alias("company_name"),
            F.concat("o_orderpriority", F.lit(" Software")).alias("title"), F.concat(F.lower("c_mktsegment"), F.lit(" analyst")).alias("normalized_title"), F.lower("c_mktsegment").alias("category"),
            F.when(k % 2 == 0, F.concat(F.lit("<p>Order of "), "c_name", F.lit(" from "), "n_name", F.lit(" with a long text that says what it is about, what is in it and who waits for it</p>"))).alias("description"),
            F.when(k % 3 == 0, F.lit("<p>Handles parts of any kind</p>")).alias("requirement_summary"), pick(3, "remote", "hybrid", "").alias("work_type"), F.lit("full_time").alias("employment_type"), pick(4, "entry_level", "mid_level", "lead", "").alias("experience_level"),
            F.when(k % 5 != 0, F.col("n_name")).alias("city"), F.col("r_name").alias("province"), F.concat("n_name", F.lit(", "), "r_name").alias("location_display"), F.lit(None).cast("string").alias("salary_display"),
            F.when(k % 2 == 1, (F.floor("o_totalprice") * 10).cast("long")).alias("salary_min"), (F.floor("o_totalprice") * 30).cast("long").alias("salary_max"), F.lit("IDR").alias("salary_currency"), F.lit("monthly").alias("salary_period"),
            F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "F", "expired").otherwise("stale").alias("status"), F.lit(None).cast("timestamp").alias("source_posted_at"), F.col("o_orderdate").alias("last_seen_at"),
            (50 + k % 51).cast("int").alias("completeness"), (40 + k % 61).cast("int").alias("fit_quality"), (k % 101).cast("int").alias("detail_readiness"), (k % 7).cast("int").alias("gap_coverage"), (F.col("o_orderstatus") != "O").alias("stale"), "confidence_avg",
            (k % 4).alias("n_interview"), (k % 11 == 0).cast("long").alias("n_accepted"), (k % 3 == 0).cast("long").alias("n_rejected"), F.concat(F.lit("m"), k % 3).alias("model_name"), (k % 2).alias("n_failed"),
            F.transform("kids", lambda x: F.struct(x["kind"].alias("type"), x["p_name"].alias("value"), x["priority"].alias("priority"), x["n"].alias("sort_order"))).alias("requirements"),
            F.transform("kids", lambda x: F.struct(x["p_name"].alias("name"), F.replace(x["p_name"], F.lit(" "), F.lit("-")).alias("slug"), x["p_type"].alias("category"))).alias("skills"),
        )

    def rows(spark, sf_dir):
        return model_rows(base(spark, sf_dir), F.lit("2024-01-31 00:00:00").cast("timestamp"))

    return {"model_rows": (rows, _sql())}


def _sql() -> str:
    """The same rows in SQL: a CTE of listings, one of what columns share, and an expression a column."""
    bar = lambda sep, *xs: f"array_to_string(list_filter([{', '.join(xs)}], lambda z: z <> ''), {sep})"
    js = lambda x: f"to_json({x})::VARCHAR"
    lit = lambda v: "'" + json.dumps(v, separators=(",", ":"), sort_keys=True).replace("'", "''") + "'"
    req = lambda t: js(f"list_transform({'reqs' if t is None else f"list_filter(reqs, lambda r: r.type = '{t}')"}, lambda r: {{'priority': r.priority, 'sort_order': r.n, 'type': r.type, 'value': r.p_name}})")
    n_of = lambda field, keys: js("{" + ", ".join(f"'{x}': len(list_filter(reqs, lambda r: r.{field} = '{x}'))" for x in sorted(keys)) + "}")
    parts = ("(completeness / 100::DOUBLE)", "(len(reqs) > 0)::INT::DOUBLE", "(len(reqs) > 0)::INT::DOUBLE", "(description <> '')::INT::DOUBLE")
    score = {t: "round_even(" + " + ".join(f"{w}::DOUBLE * {p}" for w, p in zip(ws, parts, strict=True) if w) + ", 4)" for t, ws in sorted(dataset.TASKS.items())}
    contains = lambda x, words: "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"
    families = "CASE " + " ".join(f"WHEN {contains('lower(normalized_title)', words)} THEN '{name}'" for name, words in roles.FAMILIES) + " ELSE 'other' END"
    tokens = lambda *xs: f"list_filter(string_split_regex(lower({' || chr(32) || '.join(xs)}), '[^a-zA-Z0-9]+'), lambda w: length(w) >= 3)"
    c = {
        "job_id": "job_id", "external_job_id": "'e' || k", "source_platform_slug": "source", "company_id": "c_custkey::VARCHAR", "company_name": "c_name", "dataset_version": "'1.0.0'", "dataset_schema_version": "'1.0.0'",
        "dataset_exported_at": "'2024-01-31T00:00:00Z'", "model_split": "CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.8::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END", "split_group_key": "group_key",
        "is_holdout_source": "(source = 'source_e')::INT", "is_low_confidence_label": "(completeness < 55)::INT", "label_confidence_score": "round_even(completeness / 100::DOUBLE, 4)",
        "supported_model_tasks_json": lit(list(dataset.TASKS)), "unsupported_model_tasks_json": lit(UNSUPPORTED), "model_task_readiness_json": js("{" + ", ".join(f"'{t}': {e}" for t, e in score.items()) + "}"),
        "model_task_blockers_json": js("{" + ", ".join(f"'{t}': CASE WHEN {e} >= 0.55::DOUBLE THEN []::VARCHAR[] ELSE ['insufficient_job_context'] END" for t, e in score.items()) + "}"),
        "model_input_title": "title", "model_input_normalized_title": "normalized_title", "model_input_company_context": "c_name", "model_input_location_context": "place", "model_input_salary_context": "pay",
        "model_input_description_plaintext": "plain", "model_input_requirement_summary_plaintext": "plain2", "model_input_requirements_text": "nt", "model_input_skills_text": "nt",
        "model_input_full_context": "context", "model_input_short_context": bar("' | '", "title", "c_name", "place"),
        "model_input_cv_compare_context": bar("' | '", "title", "plain2", "array_to_string(names[1:10], ' ; ')", "array_to_string(names[1:15], ' ; ')"),
        "model_input_career_copilot_context": bar("' | '", "title", "c_name", "category", "CASE WHEN len(names) > 0 THEN 'Important requirements: ' || array_to_string(names[1:8], ' ; ') ELSE '' END", "CASE WHEN len(names) > 0 THEN 'Keywords: ' || array_to_string(names[1:12], ' ; ') ELSE '' END"),
        "label_work_type": "work_type", "label_employment_type": "'FULL_TIME'", "label_experience_level": "level", "label_category": "category", "label_role_family": families,
        "label_seniority_bucket": "['entry', 'mid', 'senior', 'unknown'][k % 4 + 1]", "label_salary_bucket": "CASE WHEN mid < 5000000 THEN 'low' WHEN mid < 12000000 THEN 'mid' ELSE 'high' END", "label_location_city": "city", "label_location_province": "r_name",
        "label_is_remote_friendly": "(work_type = 'REMOTE')::INT", "label_is_entry_level_friendly": "(k % 4 = 0)::INT", "label_is_tech_or_digital_role": contains("lower(title || ' ' || array_to_string(names, ' '))", roles.TECH_TOKENS) + "::INT",
        "label_job_search_rank_bucket": "CASE WHEN k % 101 + fit + k % 4 * 5 >= 170 THEN 'top' WHEN k % 101 + fit + k % 4 * 5 >= 120 THEN 'mid' ELSE 'low' END", "label_recommendation_candidate_tier": "CASE WHEN NOT stale AND fit >= 80 THEN 'tier_1' WHEN NOT stale AND fit >= 60 THEN 'tier_2' ELSE 'tier_3' END",
        "skills_json": js("list_transform(reqs, lambda r: {'category': r.p_type, 'confidence': NULL, 'name': r.p_name, 'slug': replace(r.p_name, ' ', '-')})"), "skill_slugs_json": js("slugs"), "skill_names_json": js("names"),
        "skill_categories_json": js("list_sort(list_distinct(cats))"), "skill_count": "len(names)::INT", "skill_confidence_avg": "conf", "skill_source_quality": "CASE WHEN len(names) > 0 THEN 'explicit' ELSE 'fallback' END",
        "primary_skill_slug": "coalesce(slugs[1], '')", "primary_skill_category": "coalesce(cats[1], '')", "required_skill_keywords_json": js("req_s"), "optional_skill_keywords_json": js("opt"), "skill_embedding_text": "nt",
        "requirements_json": req(None), **{f"requirements_{t.lower()}_json": req(t) for t in TYPES}, "requirements_count_total": "len(reqs)::INT", "requirements_type_distribution_json": n_of("type", TYPES), "requirements_priority_distribution_json": n_of("priority", PRIORITIES),
        "requirement_classification_quality_score": "CASE WHEN len(reqs) > 0 THEN round_even(len(list_filter(reqs, lambda r: r.type <> 'OTHER')) / len(reqs)::DOUBLE * 0.7::DOUBLE + len(list_filter(reqs, lambda r: r.priority <> '')) / len(reqs)::DOUBLE * 0.3::DOUBLE, 4) ELSE 0.0::DOUBLE END",
        "requirement_keywords_json": js("names[1:40]"), "ats_keywords_json": js("list_sort(list_distinct(names || req_s))[1:50]"), "important_requirement_highlights_json": js("list_transform(list_filter(reqs, lambda r: r.priority = 'HIGH'), lambda r: r.p_name)[1:10]"),
        "fit_context_skills_required_json": js("req_s"), **{f"fit_context_{n}_json": js(f"list_transform(list_filter(reqs, lambda r: r.type = '{t}'), lambda r: r.p_name)") for n, t in (("experience_requirements", "EXPERIENCE"), ("education_requirements", "EDUCATION"), ("responsibilities", "RESPONSIBILITY"))},
        "fit_context_preferences_json": js("{'employment_type': 'FULL_TIME', 'experience_level': level, 'location': loc, 'salary_display': '', 'work_type': work_type}"), "skill_gap_target_skills_json": js("slugs"), "skill_gap_core_skills_json": js("req_s[1:20]"), "skill_gap_optional_skills_json": js("opt[1:20]"),
        "readiness_signal_level": "prio", "candidate_matching_weight_json": lit(WEIGHTS), "job_fit_feature_vector_json": js("[fit, len(req_s), len(names)]"), "preference_match_feature_vector_json": js("[(work_type <> '')::INT, 1, 0]"),
        "experience_match_feature_vector_json": js("[[1, 3, 5, 0][k % 4 + 1], len(req_s)]"), "skill_match_feature_vector_json": js("[len(names), len(req_s), len(list_distinct(slugs))]"), "skill_gap_feature_vector_json": js("[k % 7, len(req_s), len(opt)]"),
        "weak_label_apply_priority": "prio", "weak_label_job_quality_tier": "CASE WHEN completeness >= 80 THEN 'A' WHEN completeness >= 55 THEN 'B' ELSE 'C' END", "weak_label_market_salary_signal": "CASE WHEN low > high THEN 'outlier' ELSE 'known' END",
        "weak_label_freshness_signal": "CASE WHEN status = 'EXPIRED' THEN 'expired' WHEN stale THEN 'stale' ELSE 'fresh' END", "weak_label_search_relevance_keywords_json": js(f"list_sort(list_distinct({tokens('title', 'normalized_title', 'category', 'r_name', 'city')}))[1:50]"),
        "weak_label_role_keywords_json": js(tokens("title") + "[1:30]"), "weak_label_readiness_level": "prio", "weak_label_success_probability_bucket": "CASE WHEN k % 11 = 0 THEN 'high' WHEN prio = 'high' AND k % 3 <> 0 THEN 'medium' ELSE 'low' END",
        "weak_label_actionable_next_steps_json": f"CASE prio WHEN 'high' THEN {lit(STEPS['high'])} WHEN 'medium' THEN {lit(STEPS['medium'])} ELSE {lit(STEPS['low'])} END", "text_quality_score": "CASE WHEN length(plain) >= 80 THEN 70 ELSE 0 END + CASE WHEN length(plain2) >= 20 THEN 30 ELSE 0 END",
        "normalization_completeness_score": "completeness", "model_input_token_estimate": "greatest(1, round_even(len(regexp_extract_all(context, '\\S+')) * 1.35::DOUBLE, 0))::INT", "has_minimum_model_context": "1",
        "missing_model_context_fields_json": js("list_filter([CASE WHEN description = '' THEN 'description' END, CASE WHEN len(reqs) = 0 THEN 'requirements' END, CASE WHEN len(reqs) = 0 THEN 'skills' END], lambda x: x IS NOT NULL)"),
        "source_posted_at": "''", "last_seen_at": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')", "status": "status", "ai_request_latest_model_name": "'m' || (k % 3)", "ai_request_count_failed": "k % 2", "xai_skill_evidence_json": js("names[1:15]"),
        "xai_experience_evidence_json": js("list_transform(list_filter(reqs, lambda r: r.type = 'EXPERIENCE'), lambda r: r.p_name)[1:10]"), "xai_preference_evidence_json": js("[work_type, loc, pay]"), "xai_requirement_evidence_json": js("names[1:20]"),
        "xai_salary_location_evidence_json": js("[pay, place]"), "evaluation_expected_outputs_json": lit(EXPECTED), "evaluation_rubric_json": lit(RUBRIC),
    }
    return f"""
WITH l AS (SELECT *, CASE WHEN l_quantity < 5 THEN 'EDUCATION' WHEN l_quantity > 45 THEN 'RESPONSIBILITY' WHEN l_returnflag = 'R' THEN 'SKILL' WHEN l_returnflag = 'A' THEN 'EXPERIENCE' ELSE 'OTHER' END AS type, CASE WHEN l_quantity > 25 THEN 'HIGH' ELSE '' END AS priority FROM lineitem),
kids AS (SELECT l_orderkey, list({{'n': l_linenumber::INT, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey, 'p_name': p_name, 'p_type': p_type, 'type': type, 'priority': priority}}
    ORDER BY l_linenumber, l_partkey, l_suppkey, type, priority) AS kids, round_even(avg(round_even(l_discount * 100, 0)::BIGINT), 4) AS conf
  FROM l JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey),
b AS (SELECT *, o_orderkey AS k, o_orderkey::VARCHAR AS job_id, ['source_a', 'source_b', 'source_e'][o_orderkey % 3 + 1] AS source, o_orderpriority || ' Software' AS title, lower(c_mktsegment) || ' analyst' AS normalized_title, lower(c_mktsegment) AS category,
  CASE WHEN o_orderkey % 2 = 0 THEN '<p>Order of ' || c_name || ' from ' || n_name || ' with a long text that says what it is about, what is in it and who waits for it</p>' ELSE '' END AS description,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Handles parts of any kind' ELSE '' END AS plain2, ['REMOTE', 'HYBRID', ''][o_orderkey % 3 + 1] AS work_type, ['ENTRY_LEVEL', 'MID_LEVEL', 'LEAD', ''][o_orderkey % 4 + 1] AS level, CASE WHEN o_orderkey % 5 <> 0 THEN n_name ELSE '' END AS city,
  n_name || ', ' || r_name AS loc, CASE WHEN o_orderkey % 2 = 1 THEN floor(o_totalprice)::BIGINT * 10 END AS low, floor(o_totalprice)::BIGINT * 30 AS high, CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'STALE' END AS status,
  (50 + o_orderkey % 51)::INT AS completeness, (40 + o_orderkey % 61)::INT AS fit, o_orderstatus <> 'O' AS stale, coalesce(kids, []) AS reqs
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey LEFT JOIN kids ON l_orderkey = o_orderkey),
p AS (SELECT *, trim(regexp_replace(description, '<[^>]+>', '', 'g')) AS plain, list_transform(reqs, lambda r: r.p_name) AS names, list_transform(reqs, lambda r: replace(r.p_name, ' ', '-')) AS slugs, list_transform(reqs, lambda r: r.p_type) AS cats,
  list_transform(list_filter(reqs, lambda r: r.type = 'SKILL'), lambda r: r.p_name) AS req_s, {bar("' | '", "loc", "r_name", "city")} AS place, {bar("' | '", "coalesce(nullif(low, 0)::VARCHAR, '')", "coalesce(nullif(high, 0)::VARCHAR, '')", "'IDR'", "'MONTHLY'")} AS pay,
  lower(source) || '|' || lower(c_name) || '|' || lower(normalized_title) AS group_key, CASE WHEN low IS NULL THEN high ELSE (low + high) // 2 END AS mid, CASE WHEN stale THEN 'low' WHEN fit >= 70 THEN 'high' ELSE 'medium' END AS prio FROM b),
q AS (SELECT *, list_filter(names, lambda n: NOT list_contains(req_s, n)) AS opt, array_to_string(names, ' ; ') AS nt, ('0x' || substr(sha256(group_key), 1, 8))::BIGINT / 4294967295.0::DOUBLE AS u FROM p),
r AS (SELECT *, {bar("chr(10)", "title", "normalized_title", "c_name", "category", "place", "pay", "plain", "plain2", "nt", "nt")} AS context FROM q)
SELECT {", ".join(f"{e} AS {n}" for n, e in c.items())} FROM r"""
