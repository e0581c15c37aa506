"""The consumer's contract: payload fields with defaults and fallbacks, its rules, relations and their rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import dates, html, requirements, roles, salary, skills, text, wording
from postings.operators.delivery import status_code
from postings.operators.nested import block_text
from postings.operators.ranks import unused
from postings.operators.validate import MOST_RELATIONS, parted, violations

# fixed values: the contract's enums, lengths and texts
WORK_TYPES = ("REMOTE", "HYBRID", "ONSITE")
EMPLOYMENT_TYPES = ("FULL_TIME", "PART_TIME", "INTERNSHIP", "CONTRACT", "FREELANCE")
LEVELS = ("ENTRY_LEVEL", "JUNIOR", "MID_LEVEL", "SENIOR", "LEAD")
REQUIREMENT_TYPES = ("SKILL", "EXPERIENCE", "EDUCATION", "RESPONSIBILITY", "OTHER")
PRIORITIES = ("HIGH", "MEDIUM", "LOW")
LENGTHS = {
    "source": 80, "company": 180, "source_company_id": 120, "source_slug": 120, "logo_url": 2000, "website_url": 2000, "industry": 120, "external_id": 255, "title": 255,
    "normalized_title": 255, "category": 120, "description": 10_000, "requirement_summary": 10_000, "location_display": 255, "province": 120, "city": 120,
    "salary_display": 255, "source_url": 2000, "apply_url": 2000, "last_seen_at": 80, "run_id": 160,
}
REQUIRED = ("source", "company", "external_id", "title", "source_url", "apply_url", "last_seen_at")
RELATION_LENGTHS = {"skills": ("name", 120), "requirements": ("value", 2000)}
NO_AMOUNT_TEXTS = ("tidak dicantumkan", "not specified", "not disclosed")
ZERO_AMOUNT = r"(?i)^[^\d]*0(?:[.,0\s]*)(?:/|\b|$)"
NOT_SPECIFIED, CURRENCY = "Not specified", "IDR"

#: What ``payload_fields`` reads of a job besides its key.
JOB = (
    "source, external_id, run_id, title, normalized_title, category, company, source_company_id, source_slug, logo_url, website_url, industry, description, requirement_text, skills, "
    "work_type, employment_type, experience_level, city, region, country, location_display, is_remote, salary_min, salary_max, salary_currency, salary_period, salary_display, "
    "source_url, apply_url, posted_at, source_updated_at, last_seen_at, status"
)


def one_of(c: Column, known: tuple[str, ...]) -> Column:
    """The enum's value for a text in any case, spaces and hyphens as underscores; else null."""
    v = F.upper(roles.fold(c))
    return F.when(v.isin(*known), v)


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def with_pay(jobs: DataFrame) -> DataFrame:
    """Amounts, period, currency and display of the contract: 0 beside a real amount or a second 0 is no amount,
    a display text without meaning goes, amounts are displayed anew, and the default text stands where nothing is known.
    """
    zero = lambda c: F.coalesce(F.col(c) == 0, F.lit(False))
    other = lambda c: F.coalesce(F.col(c) >= 0, F.lit(False))
    low = F.when(~(zero("salary_min") & other("salary_max")), F.col("salary_min"))
    high = F.when(~(zero("salary_max") & other("salary_min")), F.col("salary_max"))
    code = F.upper(F.trim(F.col("salary_currency")))
    jobs = jobs.withColumns({
        "salary_min": low, "salary_max": high, "salary_display": text.clean(F.col("salary_display")),
        "salary_currency": F.coalesce(F.when(code != "", code), F.lit(CURRENCY)),
        "salary_period": F.upper(F.coalesce(salary.period_of(F.col("salary_period")), salary.label_period(F.col("salary_display")))),
    })
    jobs = jobs.withColumn("salary_period", F.when(F.col("salary_period") == "YEARLY", "YEARLY").otherwise("MONTHLY"))
    shown = F.when(~F.lower("salary_display").isin(*NO_AMOUNT_TEXTS) & ~F.col("salary_display").rlike(ZERO_AMOUNT), F.col("salary_display"))
    made = salary.display(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"), F.lower("salary_period"))
    return jobs.withColumn("salary_display", F.coalesce(made, shown, F.lit(NOT_SPECIFIED)))


def payload_fields(jobs: DataFrame, keys: list[str], list_only: tuple[str, ...] = ()) -> DataFrame:
    """Jobs as the contract's fields, in one row each: (keys, the names of LENGTHS and the enums, dates as ISO-8601, ``source_name``).

    A missing apply URL is the source URL, a missing normalised title the title. Descriptions are display HTML; one missing
    from a source in ``list_only`` is a summary of what is known. Work type, employment type and level fall back to
    ONSITE, FULL_TIME and what title and texts say (ENTRY_LEVEL at the end).
    """
    place = roles.location(F.col("city"), F.col("region"), F.col("country"), F.col("location_display"), F.col("is_remote"))
    jobs = with_pay(jobs).withColumns({"_place": place, "_body": text.clean_description(F.col("description")), "_wanted": text.clean_description(block_text(F.col("requirement_text")))})
    limited = F.when(F.lower("source").isin(*list_only), wording.limited_summary(F.col("title"), F.col("company"), F.col("_place.display"), F.col("source")))
    shown = lambda c: F.when(c.rlike("<[^>]+>"), c).otherwise(html.display(c))
    names = skills.sanitised_skills(F.coalesce("skills", F.array().cast("array<string>")))
    jobs = jobs.withColumns({"_body": F.coalesce(F.col("_body"), limited), "_summary": skills.summary(skills.items(F.col("_wanted")), names)})
    jobs = jobs.withColumn("_level", roles.level_text(F.col("title"), F.col("_body"), F.col("_wanted")))
    date = lambda c: dates.iso_z(F.col(c))
    trimmed = lambda c: text.clean(F.col(c))
    return jobs.select(
        *keys, F.lower(F.trim("source")).alias("source"), wording.source_name(F.col("source")).alias("source_name"), F.trim("external_id").alias("external_id"), trimmed("run_id").alias("run_id"),
        trimmed("title").alias("title"), F.coalesce(trimmed("normalized_title"), trimmed("title")).alias("normalized_title"), trimmed("category").alias("category"), trimmed("company").alias("company"),
        *(trimmed(c).alias(c) for c in ("source_company_id", "source_slug", "logo_url", "website_url", "industry")),
        shown(F.col("_body")).alias("description"), F.col("_summary").alias("requirement_summary"),
        F.coalesce(one_of(F.col("work_type"), WORK_TYPES), F.lit("ONSITE")).alias("work_type"), F.coalesce(one_of(F.col("employment_type"), EMPLOYMENT_TYPES), F.lit("FULL_TIME")).alias("employment_type"),
        F.coalesce(one_of(F.col("experience_level"), LEVELS), F.upper(roles.infer_level(F.col("_level"))), F.lit("ENTRY_LEVEL")).alias("experience_level"),
        F.col("_place.display").alias("location_display"), F.col("_place.region").alias("province"), F.col("_place.city").alias("city"),
        "salary_min", "salary_max", "salary_currency", "salary_period", "salary_display", trimmed("source_url").alias("source_url"), F.coalesce(trimmed("apply_url"), trimmed("source_url")).alias("apply_url"),
        date("posted_at").alias("posted_at"), date("source_updated_at").alias("source_updated_at"), date("last_seen_at").alias("last_seen_at"), status_code(F.lower(F.trim("status"))).alias("status"),
    )


def skill_names(c: Column) -> Column:
    """Skills of one staged value: split, cleaned, those that say nothing left out."""
    return skills.sanitised_skills(F.array(c))


def requirement_value(c: Column) -> Column:
    """A staged requirement as plain text; null if it is noise or says nothing."""
    return text.once(block_text(c), lambda v: F.when(~requirements.is_noise(v) & ~skills.is_low_signal(v), v))


def relation_lists(rows: DataFrame, job: str, order: list[str]) -> DataFrame:
    """(job, skills, requirements, refused): each job's relations in order, those seen before (case and ends aside) left out.

    ``rows`` are staged relations (job, names, type, value, priority, confidence, origin): ``names`` as of ``skill_names``,
    ``value`` as of ``requirement_value``; one row may be both kinds. ``refused`` is the reason if a type is outside the enum.
    Rows are dealt by job once, as they are, and both lists are made where they arrive, so nothing larger is shuffled or sorted.
    Rows that say the same are put together before a job's are gathered, so its list holds different ones only.
    """
    said = ["names", "type", "value", "priority"]
    rows = rows.select(*dict.fromkeys([job, *said, *order, "confidence", "origin"])).repartition(job)
    rows = rows.withColumns({"type": F.upper(F.trim("type")), "priority": F.upper(F.trim("priority"))})
    at = F.struct(*order, F.col("confidence").cast("double").alias("_confidence"), F.col("origin").alias("_origin"))
    once = rows.groupBy(job, *said).agg(F.min(at).alias("at"))
    lists = once.groupBy(job).agg(F.sort_array(F.collect_list(F.struct("at", *said))).alias("all"))
    valid = lambda r: F.coalesce(r["type"].isin(*REQUIREMENT_TYPES), F.lit(False))
    confidence, origin = lambda r: r["at"]["_confidence"].alias("confidence"), lambda r: r["at"]["_origin"].alias("source")
    named = F.flatten(F.transform("all", lambda r: F.transform(r["names"], lambda n: F.struct(F.trim(n).alias("name"), confidence(r), origin(r)))))
    told = F.filter("all", lambda r: valid(r) & ~_blank(r["value"]))
    wanted = F.transform(told, lambda r: F.struct(r["type"].alias("type"), r["value"].alias("value"), r["priority"].alias("priority"), confidence(r), origin(r)))
    return lists.select(
        job, text.first_by(named, lambda x: F.lower(x["name"])).alias("skills"), text.first_by(wanted, lambda x: F.lower(F.trim(F.concat_ws(" ", x["type"], x["value"])))).alias("requirements"),
        F.when(F.exists("all", lambda r: ~valid(r)), F.lit("bad_requirement_type")).alias("refused"),
    )


def job_skills(rows: DataFrame, job: str, order: list[str]) -> DataFrame:
    """(job, list) of staged skills (job, value, confidence, origin): split, cleaned, each once, those that say nothing left out."""
    none = F.lit(None).cast("string")
    named = rows.withColumns({"names": skill_names(F.col("value")), "type": F.lit("OTHER"), "value": none, "priority": none})
    return relation_lists(named, job, order).select(job, F.col("skills").alias("list")).where(F.size("list") > 0)


def job_requirements(rows: DataFrame, job: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """((job, list), (job, reason)) of staged requirements (job, type, value, priority, confidence, origin).

    Noise and what says nothing is left out; a type outside the enum rejects its job. Lists hold a value once a type.
    """
    told = rows.withColumns({"names": F.array().cast("array<string>"), "value": requirement_value(F.col("value"))})
    lists = relation_lists(told, job, order)
    bad = lists.where("refused is not null").select(job, F.col("refused").alias("reason"))
    return lists.select(job, F.col("requirements").alias("list")).where(F.size("list") > 0), bad


def orphan_relations(rows: DataFrame, job: str, jobs: DataFrame, key: str, name: str) -> DataFrame:
    """(job, relation, n) of relations whose job isn't there; a null job is one."""
    known = jobs.select(F.col(key).alias("known")).where("known is not null").distinct()
    lost = rows.join(known, F.col(job) == F.col("known"), "left_anti")
    return lost.groupBy(job).agg(F.count(F.lit(1)).alias("n")).select(job, F.lit(name).alias("relation"), "n")


def contract_rules() -> dict[str, Column]:
    """The contract's rules over ``payload_fields`` with ``skills`` and ``requirements`` lists: name to "is broken"."""
    share = lambda c: F.exists(c, lambda x: (x["confidence"] < 0) | (x["confidence"] > 1))
    long = lambda c, field, n: F.exists(c, lambda x: F.length(x[field]) > n)
    rules = {f"missing_{c}": _blank(F.col(c)) for c in REQUIRED}
    rules |= {f"{c}_too_long": F.length(c) > n for c, n in LENGTHS.items()}
    rules |= {f"{c}_negative": F.col(c) < 0 for c in ("salary_min", "salary_max")}
    rules |= {"salary_reversed": F.col("salary_min") > F.col("salary_max"), "bad_currency": F.length("salary_currency") != 3}
    for relation, (field, n) in RELATION_LENGTHS.items():
        rules |= {f"too_many_{relation}": F.size(relation) > MOST_RELATIONS, f"{relation}_confidence": share(relation), f"{relation}_too_long": long(relation, field, n)}
    rules["bad_priority"] = F.exists("requirements", lambda x: x["priority"].isNotNull() & ~x["priority"].isin(*PRIORITIES))
    return rules


def _judged(both: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``consumer_payloads`` of fields with lists ``skills`` and ``requirements`` (null: none) and reasons ``refused`` (null: none)."""
    both = both.withColumns({c: F.coalesce(c, F.array()) for c in ("skills", "requirements")})
    judged = both.withColumn("reasons", F.concat(violations(contract_rules()), F.coalesce("refused", F.array().cast("array<string>")))).drop("refused")
    good, bad = parted(judged, "reasons")
    return good.drop("reasons"), bad.select(*keys, "reasons")


def consumer_payloads(fields: DataFrame, keys: list[str], skill_lists: DataFrame, requirement_lists: DataFrame, rejected: DataFrame, job: str) -> tuple[DataFrame, DataFrame]:
    """((keys, fields, lists), (keys, reasons)): jobs that keep the contract, and the others with every rule they break.

    ``rejected`` (job, reason) are jobs that a relation has rejected. Jobs without relations have empty lists.
    """
    both = fields
    for df, name in ((skill_lists, "skills"), (requirement_lists, "requirements")):
        both = both.join(df.select(F.col(job).alias(f"of_{name}"), F.col("list").alias(name)), F.col(keys[0]) == F.col(f"of_{name}"), "left").drop(f"of_{name}")
    reasons = rejected.groupBy(F.col(job).alias("of_job")).agg(F.array_sort(F.collect_set("reason")).alias("refused"))
    return _judged(both.join(reasons, F.col(keys[0]) == F.col("of_job"), "left").drop("of_job"), keys)


def related_payloads(fields: DataFrame, keys: list[str], relations: DataFrame, job: str) -> tuple[DataFrame, DataFrame]:
    """``consumer_payloads`` of fields and ``relation_lists``, which are dealt alike: the join moves the fields only."""
    both = fields.join(relations.withColumnRenamed(job, "of_job").withColumn("refused", F.array_compact(F.array("refused"))), F.col(keys[0]) == F.col("of_job"), "left")
    return _judged(both.drop("of_job"), keys)


def payload_json(valid: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, payload, payload_hash): the nested payload as JSON with the contract's names, nulls left out."""
    as_ = lambda **named: F.struct(*(F.col(c).alias(n) for n, c in named.items()))
    listing = as_(
        externalJobId="external_id", title="title", normalizedTitle="normalized_title", category="category", description="description", requirementSummary="requirement_summary", workType="work_type",
        employmentType="employment_type", experienceLevel="experience_level", locationDisplay="location_display", province="province", city="city", salaryMin="salary_min", salaryMax="salary_max",
        salaryCurrency="salary_currency", salaryPeriod="salary_period", salaryDisplay="salary_display", sourceUrl="source_url", externalApplyUrl="apply_url", sourcePostedAt="posted_at",
        sourceUpdatedAt="source_updated_at", lastSeenAt="last_seen_at", status="status",
    )
    company = as_(name="company", sourceCompanyId="source_company_id", sourceSlug="source_slug", logoUrl="logo_url", websiteUrl="website_url", industry="industry")
    body = F.struct(
        as_(slug="source", name="source_name").alias("sourcePlatform"), company.alias("company"), F.when(F.col("run_id").isNotNull(), as_(sourceRunId="run_id")).alias("ingestionRun"),
        listing.alias("jobListing"), F.col("requirements"), F.col("skills"),
    )
    return valid.select(*keys, F.to_json(body).alias("payload")).withColumn("payload_hash", F.sha2("payload", 256))
