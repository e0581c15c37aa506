"""Outputs of a language model held against their requests and merged with the source's evidence, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import dates, html, roles, salary, text, wording
from postings.operators.nested import best_evidence, block_text, evidence
from postings.operators.validate import STATUSES, parted, violations

#: What is read of an output; other keys break a rule.
OUTPUT = (
    "source struct<source_url: string, external_apply_url: string, external_id: string>, title string, company struct<name: string>, description string, requirements string, skills array<string>, "
    "work_type string, employment_types array<string>, experience_level string, location struct<city: string, region: string, country: string, display: string, is_remote: boolean>, "
    "salary struct<min_amount: double, max_amount: double, currency: string, period: string, display: string>, status string"
)
OUTPUT_KEYS = ("source", "title", "company", "description", "requirements", "skills", "work_type", "employment_types", "experience_level", "location", "salary", "status")
LIST, HOME_SOURCES = "list", ("source_a", "source_b", "source_c", "source_d", "source_e")


def batch_orders(requests: DataFrame, outputs: DataFrame) -> DataFrame:
    """(batch_id, expected, actual, in_order): whether a batch's outputs are its requests' items in their order, one by one.

    Both have (batch_id, position, item_id); a batch is bounded by its contract. A batch of one side only is not in order.
    """
    ids = lambda df, name: df.groupBy("batch_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "item_id"))), lambda x: x["item_id"]).alias(name))
    both = ids(requests, "expected").join(ids(outputs, "actual"), "batch_id", "full_outer")
    return both.withColumn("in_order", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))


def output_rules() -> dict[str, Column]:
    """Rules of one parsed output ``o`` with its JSON ``output``: name to "is broken"."""
    read = F.json_object_keys("output").isNotNull()
    blank = lambda c: read & (F.coalesce(F.trim(F.col(c)), F.lit("")) == "")
    pay = F.col("o.salary")
    return {
        "not_an_object": ~read,
        "unknown_key": F.exists(F.json_object_keys("output"), lambda k: ~k.isin(*OUTPUT_KEYS)),
        "missing_title": blank("o.title"), "missing_company": blank("o.company.name"), "missing_source_url": blank("o.source.source_url"),
        "negative_amount": (pay["min_amount"] < 0) | (pay["max_amount"] < 0), "bad_currency": F.length(F.trim(pay["currency"])) != 3, "bad_status": ~F.col("o.status").isin(*STATUSES),
    }


def merged_fields(requests: DataFrame, outputs: DataFrame, *, language: str = "english", limited_sources: tuple[str, ...] = ("source_b",)) -> tuple[DataFrame, DataFrame]:
    """((item_id, field, value, origin), (item_id, reasons)) of model outputs and their requests.

    ``requests``: (batch_id, position, item_id, source, endpoint, raw JSON, scraped_at); ``outputs``: (batch_id, position,
    item_id, output JSON, error). Item ids are unique. An item is rejected if its batch's items aren't the
    requested ones in order, if it has an error, breaks a rule of its own, or if a list-only listing of ``limited_sources`` has no
    description at the end; other items of its batch stay. Fields of the rest, with where the value came from:
    ``model``, ``evidence`` (the raw JSON, where the model gave nothing), ``default``, ``derived`` (from
    other fields) or ``run``. The time of the run always wins for scraped_at and last_seen_at.
    """
    order = batch_orders(requests, outputs).select("batch_id", "in_order")
    rows = requests.select("batch_id", "item_id", "source", "endpoint", "raw", "scraped_at").join(outputs.select("item_id", "output", "error"), "item_id", "left").join(order, "batch_id")
    rows = rows.withColumn("o", F.from_json("output", OUTPUT, {"mode": "PERMISSIVE"}))
    rules = {"item_order_mismatch": ~F.col("in_order"), "model_error": F.col("error").isNotNull()} | output_rules()
    rows = rows.withColumn("reasons", violations(rules))
    best = best_evidence(evidence(requests, ["item_id"], "raw"), ["item_id"]).withColumnsRenamed({"description": "e_description", "requirement": "e_requirement", "skills": "e_skills"})
    rows = rows.join(best, "item_id", "left")
    rows = salary.normalized(rows, F.col("o.salary.min_amount"), F.col("o.salary.max_amount"), F.coalesce(F.col("o.salary.currency"), F.lit("IDR")), F.col("o.salary.period"), F.col("o.salary.display"), "pay")
    o = lambda name: F.col(f"o.{name}")
    place = roles.location(o("location.city"), o("location.region"), o("location.country"), o("location.display"), o("location.is_remote"))
    wanted = text.clean_description(block_text(o("requirements")))
    rows = rows.withColumns({"place": place, "given": block_text(o("description")), "wanted": wanted, "named": F.filter(F.coalesce(o("skills"), F.array()), lambda s: F.trim(s) != "")})
    detailed = F.col("e_description").isNotNull() | F.col("e_requirement").isNotNull()
    limited = F.col("source").isin(*limited_sources) & (F.col("endpoint") == LIST) & ~detailed
    summary = F.when(limited, html.display(wording.limited_summary(o("title"), o("company.name"), F.col("place.display"), F.col("source"), language)))
    shown = F.when(F.col("given").isNotNull(), F.when(o("description").rlike("<[^>]+>"), o("description")).otherwise(html.display(o("description"))))
    rows = rows.withColumns({"limited": limited, "summary": summary, "shown": shown, "from_evidence": _sentence(language)})
    rows = rows.withColumn("level_text", roles.level_text(o("title"), F.col("given"), F.col("wanted")))
    run_at = dates.iso_z(F.col("scraped_at"))
    home = F.when(F.col("source").isin(*HOME_SOURCES), wording.home_country(F.lit(None).cast("string"), o("location.city"), o("location.region"), F.col("place.display")))
    fields = {
        "title": [(text.clean(o("title")), "model")],
        "company": [(text.clean(o("company.name")), "model")],
        "source_url": [(text.clean(o("source.source_url")), "model")],
        "external_apply_url": [(text.clean(o("source.external_apply_url")), "model"), (text.clean(o("source.source_url")), "default")],
        "description": [(F.col("shown"), "model"), (F.col("summary"), "derived"), (F.col("e_description"), "evidence"), (F.col("from_evidence"), "derived")],
        "requirements": [(F.col("wanted"), "model"), (F.col("e_requirement"), "evidence")],
        "skills": [(_listed(F.col("named")), "model"), (_listed(F.col("e_skills")), "evidence")],
        "work_type": [(_known(roles.work_type(o("work_type"))), "model"), (F.lit("onsite"), "default")],
        "employment_type": [(_known(roles.employment_type(F.get(o("employment_types"), F.lit(0)))), "model"), (F.lit("full_time"), "default")],
        "experience_level": [(text.clean(o("experience_level")), "model"), (roles.infer_level(F.col("level_text")), "derived")],
        "country": [(text.clean(o("location.country")), "model"), (home, "default")],
        "location": [(F.col("place.display"), "model")],
        "salary_min": [(F.col("pay.min_amount").cast("string"), "model")],
        "salary_max": [(F.col("pay.max_amount").cast("string"), "model")],
        "scraped_at": [(run_at, "run")],
        "last_seen_at": [(run_at, "run")],
    }
    late = F.when(F.col("limited") & F.coalesce("shown", "summary").isNull(), F.array(F.lit("source_limited_summary_required"))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("reasons", F.when(F.size("reasons") == 0, late).otherwise(F.col("reasons")))
    valid, rejected = parted(rows, "reasons")
    # each value is a column before it is mentioned twice, as what is chosen and as what tells the origin
    options = {f"{name}_{i}": value for name, few in fields.items() for i, (value, _) in enumerate(few)}
    given = valid.select("item_id", *(value.alias(c) for c, value in options.items()))
    chosen = [F.struct(F.lit(name).alias("field"), *_first([(F.col(f"{name}_{i}"), origin) for i, (_, origin) in enumerate(few)])) for name, few in fields.items()]
    good = given.select("item_id", F.explode(F.array(*chosen)).alias("f")).select("item_id", "f.*")
    return good.where("value is not null"), rejected.select("item_id", "reasons")


def _first(options: list[tuple[Column, str]]) -> list[Column]:
    """(value, origin): the first option that has a value."""
    origin = F.lit(None).cast("string")
    for value, name in reversed(options):
        origin = F.when(value.isNotNull(), name).otherwise(origin)
    return [F.coalesce(*(v for v, _ in options)).alias("value"), origin.alias("origin")]


def _listed(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, ", "))


def _known(c: Column) -> Column:
    return F.when(c != "unknown", c)


def _sentence(language: str) -> Column:
    """A description made of title, company and evidence, where nothing else describes the job."""
    title, company = text.clean(F.col("o.title")), text.clean(F.col("o.company.name"))
    if language == "english":
        parts = ("The ", " role at ", "the related company", " focuses on carrying out core responsibilities supported by the available source evidence.", " Core qualifications include: ", " Required skills include: ")
    else:
        parts = ("Posisi ", " di ", "perusahaan terkait", " berfokus pada pelaksanaan tanggung jawab teknis sesuai kebutuhan bisnis.", " Kualifikasi inti mencakup: ", " Keahlian yang dibutuhkan antara lain: ")
    first = F.concat(F.lit(parts[0]), title, F.lit(parts[1]), F.coalesce(company, F.lit(parts[2])), F.lit(parts[3]))
    named = F.when(F.size("e_skills") > 0, F.concat(F.lit(parts[5]), F.array_join(F.slice("e_skills", 1, 8), ", "), F.lit(".")))
    return F.concat(first, F.coalesce(F.concat(F.lit(parts[4]), F.col("e_requirement")), named, F.lit("")))
