"""Semantic and display quality: noise, sparse requirements, unsafe HTML, secrets; warnings with their severity; paging of captured pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import clean_html, html, redact
from postings.functions.text import has_legacy_heading

# fixed values: words of benefits, and the bounds of the warnings
NOISE = ("tunjangan", "benefit", "bonus", "bpjs", "cuti", "fasilitas", "gaji pokok", "thr")
SINGLE_RATE, OTHER_RATE, FEWEST_JOBS = 0.95, 0.5, 3


def is_noisy(c: Column) -> Column:
    """Whether a text has a word of benefits by itself: commas, points, brackets and slashes count as spaces."""
    padded = F.concat(F.lit(" "), F.lower(F.translate(c, ",.()/", "     ")), F.lit(" "))
    found = F.lit(False)
    for phrase in NOISE:
        found = found | F.contains(padded, F.lit(f" {phrase} "))
    return F.coalesce(found, F.lit(False))


def is_sensitive(c: Column) -> Column:
    """Whether a text holds a database URL, a cookie, an authorization or anything that redaction changes; null holds nothing."""
    low = F.lower(c)
    has = lambda s: F.contains(low, F.lit(s))
    found = has("postgresql://") | has("postgresql+asyncpg://") | (has("cookie") & has("=")) | (has("authorization") & has("bearer")) | (redact.redact(c) != c)
    return F.coalesce(found, F.lit(False))


def ensure_display(c: Column) -> Column:
    """Display HTML of any text: sanitised if it has tags and anything is left of it, else as a paragraph or a list."""
    safe = F.when(c.rlike("<[^>]+>"), clean_html.sanitise(c))
    return F.coalesce(F.nullif(F.trim(safe), F.lit("")), html.display(c))


def display_quality(df: DataFrame, by: list[str], description: str, summary: str) -> DataFrame:
    """(by, safe_display_html, unsafe_html, requirement_summary_prefix) counts; a row is safe if both of its texts are. Null and blank texts are."""
    safe = lambda c: (F.trim(F.coalesce(F.col(c), F.lit(""))) == "") | F.coalesce(html.is_safe(F.col(c)), F.lit(True))
    both = safe(description) & safe(summary)
    return df.groupBy(*by).agg(
        F.count_if(both).alias("safe_display_html"), F.count_if(~both).alias("unsafe_html"), F.count_if(has_legacy_heading(F.col(summary))).alias("requirement_summary_prefix")
    )


def requirement_totals(jobs: DataFrame, requirements: DataFrame, job: str, source: str) -> DataFrame:
    """(source, jobs, requirements, other, single, noisy) of jobs (job, source) and requirements (job, type, value).

    Requirements are put together a job before the join, so it has one row a job on either side.
    """
    kids = requirements.groupBy(job).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("type") == "OTHER").alias("other"), F.count_if(is_noisy(F.col("value"))).alias("noisy"))
    row = jobs.select(job, source).join(kids, job, "left").na.fill(0, ["n", "other", "noisy"])
    return row.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("jobs"), F.sum("n").alias("requirements"), F.sum("other").alias("other"), F.count_if(F.col("n") == 1).alias("single"), F.sum("noisy").alias("noisy")
    )


def semantic_warnings(totals: DataFrame, enabled: DataFrame, list_only: tuple[str, ...] = ()) -> DataFrame:
    """(name, severity, source) of the six rules over ``requirement_totals`` and sources (source, enabled); source is null for all.

    Sources in ``list_only`` have no details to be judged by, nor have sources of fewer than three jobs.
    """
    known = enabled.select("source", "enabled")
    each = totals.join(known, "source", "full_outer").na.fill(0, ["jobs", "requirements", "other", "single", "noisy"])
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    sparse = (rate("requirements", "jobs") <= 1) | ((rate("single", "jobs") >= SINGLE_RATE) & (rate("other", "requirements") >= OTHER_RATE))
    judged = (F.col("jobs") >= FEWEST_JOBS) & ~F.col("source").isin(*list_only) if list_only else F.col("jobs") >= FEWEST_JOBS
    of_source = [("disabledSourcePresent", "fail", ~F.col("enabled") & (F.col("jobs") > 0)), ("enabledSourceMissing", "warn", F.col("enabled") & (F.col("jobs") == 0)), ("detailCapableRequirementQuality", "fail", judged & sparse)]
    whole = totals.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("jobs", "requirements", "other", "single", "noisy"))).withColumn("source", F.lit(None).cast("string"))
    of_all = [
        ("requirementsOtherRate", "fail", (F.col("requirements") > 0) & (F.col("other") == F.col("requirements"))), ("jobsWithSingleRequirementRate", "fail", (F.col("jobs") > 0) & (F.col("single") == F.col("jobs"))),
        ("noisyRequirementCount", "fail", F.col("noisy") > 0),
    ]

    def fired(df: DataFrame, rules: list) -> DataFrame:
        found = F.array_compact(F.array(*(F.when(broken, F.struct(F.lit(n).alias("name"), F.lit(s).alias("severity"))) for n, s, broken in rules)))
        return df.select("source", F.explode(found).alias("w")).select("w.name", "w.severity", "source")

    return fired(each, of_source).unionByName(fired(whole, of_all))


@dataclass(frozen=True)
class Paging:
    """Paths of a source's page number, page size, total and number of pages; without the last, it is the total by the size."""

    rows: str
    page: str
    size: str
    total: str
    pages: str | None = None


PAGING = {
    "source_a": Paging("$.data.docs", "$.data.page", "$.data.limit", "$.data.totalDocs", "$.data.totalPages"),
    "source_c": Paging("$.data.jobSearchV6.data", "$.data.jobSearchV6.searchParams.page", "$.data.jobSearchV6.searchParams.pageSize", "$.data.jobSearchV6.totalCount"),
}


def page_totals(pages: DataFrame, source: str) -> DataFrame:
    """(page_id, page, size, total, pages, rows) of captured pages (page_id, payload): what the source says, else page 1, the rows there are (1 at least) as size, the rows as total.

    Numbers below their least (1 for page and size, 0 for totals) count as missing; pages whose payload isn't JSON or has no list have no row.
    """
    p = PAGING[source]
    v = pages.select("page_id", F.try_parse_json("payload").alias("v"))
    number = lambda path, least: F.when(F.schema_of_variant(F.try_variant_get("v", path, "variant")) == "BIGINT", F.nullif(F.greatest(F.try_variant_get("v", path, "bigint"), F.lit(least - 1)), F.lit(least - 1)))
    read = v.select("page_id", F.size(F.try_variant_get("v", p.rows, "array<variant>")).cast("long").alias("rows"), number(p.page, 1).alias("page"), number(p.size, 1).alias("size"), number(p.total, 0).alias("total"), (number(p.pages, 0) if p.pages else F.lit(None).cast("long")).alias("pages"))
    read = read.where("rows >= 0").select("page_id", "rows", F.coalesce("page", F.lit(1)).alias("page"), F.coalesce("size", F.greatest("rows", F.lit(1))).alias("size"), F.coalesce("total", "rows").alias("total"), "pages")
    counted = F.coalesce("pages", F.lit(0)) if p.pages else F.ceil(F.col("total") / F.col("size"))
    return read.select("page_id", "page", "size", "total", counted.cast("long").alias("pages"), "rows")
