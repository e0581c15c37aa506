"""Raw rows of five sources to one canonical record: paths by source, one expression for all."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import dates, html, roles, salary
from postings.functions.text import clean, clean_description

ZERO_IS_NONE = "zero_is_none"


@dataclass(frozen=True)
class Paths:
    """JSON paths of a canonical field, the first with a value wins; "$.detail" parts override the list's."""

    title: tuple[str, ...]
    company: tuple[str, ...]
    slug: tuple[str, ...] = ("$.slug",)
    city: tuple[str, ...] = ()
    region: tuple[str, ...] = ()
    country: tuple[str, ...] = ()
    place: tuple[str, ...] = ()
    low: tuple[str, ...] = ()
    high: tuple[str, ...] = ()
    currency: tuple[str, ...] = ()
    period: tuple[str, ...] = ()
    pay: tuple[str, ...] = ()
    kinds: tuple[str, ...] = ()
    work: tuple[str, ...] = ()
    level: tuple[str, ...] = ()
    posted: tuple[str, ...] = ()
    updated: tuple[str, ...] = ()
    label: tuple[str, ...] = ()
    status: tuple[str, ...] = ()
    skills: tuple[str, str] | None = None
    category: tuple[str, ...] = ()
    description: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    flags: tuple[str, ...] = ()


#: Where each source keeps what.
SOURCES = {
    "source_a": Paths(
        title=("$.role",), company=("$.company.name",), city=("$.city.name",), country=("$.country.name",), low=("$.salaryRange.start",), high=("$.salaryRange.end",),
        kinds=("$.employmentTypes[0]",), work=("$.workplaceType",), level=("$.experienceLevel",), posted=("$.publishedAt",), updated=("$.latestUpdatedAt", "$.updatedAt"), status=("$.status",),
        skills=("$.skills", "$.name"), description=("$.detail.description", "$.description"), needs=("$.detail.requirements", "$.detail.qualifications"),
    ),
    "source_b": Paths(
        title=("$.title",), company=("$.company.brandName", "$.company.name"), place=("$.location.formattedName",), country=("$.country.name",), low=("$.salaries[0].minAmount",), high=("$.salaries[0].maxAmount",),
        currency=("$.salaries[0].CurrencyCode",), period=("$.salaries[0].salaryMode",), kinds=("$.type",), work=("$.workArrangementOption",), posted=("$.createdAt",), updated=("$.updatedAt",), status=("$.status",),
        skills=("$.skills", "$.skill.name"), category=("$.hierarchicalJobCategory.name",), defaults={"status": "active"},
    ),
    "source_c": Paths(
        title=("$.detail.job.title", "$.title"), company=("$.detail.job.advertiser.name", "$.companyName"), place=("$.detail.job.location.label", "$.locations[0].label"), pay=("$.detail.job.salary.label", "$.salaryLabel"),
        kinds=("$.workTypes[0]",), work=("$.workArrangements.displayText",), posted=("$.listingDate.dateTimeUtc",), label=("$.listingDate.label",), status=("$.detail.job.status",),
        description=("$.detail.job.content", "$.teaser"), needs=("$.bulletPoints[0]",), defaults={"status": "active"},
    ),
    "source_d": Paths(
        title=("$.name",), company=("$.companyName", "$.company.name"), city=("$.googleLocation.addressComponents.city",), region=("$.googleLocation.addressComponents.region",),
        country=("$.googleLocation.addressComponents.country",), low=("$.baseSalary",), high=("$.maximumSalary",), currency=("$.salaryCurrency",), period=("$.salaryInterval",), kinds=("$.tenure",),
        posted=("$.activationDate", "$.createdAt"), skills=("$.jobSdsSkills", "$.name"), description=("$.description",), needs=("$.qualifications",), defaults={"status": "active"}, flags=("$.isWorkFromHome", "$.isHybrid"),
    ),
    "source_e": Paths(
        title=("$.positionName",), company=("$.company.name",), city=("$.city.name",), region=("$.province.name",), low=("$.salaryLowerBound",), high=("$.salaryUpperBound",), kinds=("$.typeStr",),
        work=("$.locationSiteStr",), updated=("$.updatedAtStr",), category=("$.jobRole.displayName",), description=("$.detail.formattedDescription", "$.description"), defaults={"status": "active", "amounts": ZERO_IS_NONE},
    ),
}


def _first(paths: tuple[str, ...], kind: str = "string") -> Column:
    found = [F.try_variant_get("v", p, kind) for p in paths]
    if kind == "string":
        found = [clean(c) for c in found]
    return F.coalesce(*found) if found else F.lit(None).cast(kind)


def _winner(paths: tuple[str, ...]) -> Column:
    """The path that gives ``_first`` its value."""
    found = F.lit(None).cast("string")
    for p in reversed(paths):
        found = F.when(clean(F.try_variant_get("v", p, "string")).isNotNull(), p).otherwise(found)
    return found


def map_source(rows: DataFrame, source: str) -> DataFrame:
    """Canonical records of rows(source, external_id, payload, scraped_at): typed columns, null where the source says nothing.

    No shuffle; the payload is parsed once, as a variant. Projections are layered: what later
    columns use several times is a column first, so nothing is computed twice.
    ``provenance`` tells for each field which path gave its value; fields without one aren't in it.
    """
    p = SOURCES[source]
    amount = lambda paths: F.nullif(_first(paths, "long"), F.lit(0)) if p.defaults.get("amounts") == ZERO_IS_NONE else _first(paths, "long")
    yes = lambda path, other: F.coalesce(F.try_variant_get("v", path, "boolean"), F.lit(other))
    remote, hybrid = (yes(f, False) for f in p.flags) if p.flags else (F.lit(False), F.lit(False))
    names = F.transform(F.try_variant_get("v", p.skills[0], "array<variant>"), lambda x: clean(F.try_variant_get(x, p.skills[1], "string"))) if p.skills else F.array().cast("array<string>")
    texts = ("title", "slug", "company", "category", "city", "region", "country", "place", "currency", "period", "pay", "kinds", "work", "level", "posted", "updated", "label", "status", "description", "needs")
    df = rows.select("source", "external_id", "scraped_at", F.sha2("payload", 256).alias("raw_hash"), F.try_parse_json("payload").alias("v"))
    traced = [n for n in ("title", "company", "place", "city", "low", "pay", "posted", "description") if getattr(p, n)]
    df = df.select(
        "source", "external_id", "scraped_at", "raw_hash", *(_winner(getattr(p, n)).alias(f"p_{n}") for n in traced), *(_first(getattr(p, n)).alias(f"t_{n}") for n in texts), amount(p.low).alias("t_low"), amount(p.high).alias("t_high"),
        remote.alias("t_remote"), hybrid.alias("t_hybrid"), (yes("$.isClosed", False) | ~yes("$.isPublished", True)).alias("t_closed"), names.alias("t_names"),
    )
    df = df.withColumns({
        "work_type": F.when(F.col("t_remote"), "remote").when(F.col("t_hybrid"), "hybrid").otherwise(roles.work_type(F.col("t_work"))),
        "status": F.when(F.col("t_closed"), "inactive").otherwise(roles.job_status(F.coalesce("t_status", F.lit(p.defaults.get("status"))))),
        "t_description": html.to_text(F.col("t_description")), "t_needs": html.to_text(F.col("t_needs")),
    })
    df = df.withColumns({"t_description": clean_description(F.col("t_description")), "t_needs": clean(F.col("t_needs"))})
    df = df.withColumn("t_text", roles.level_text(F.col("t_title"), F.col("t_description"), F.col("t_needs")))
    df = df.withColumn("experience_level", F.coalesce(F.nullif(roles.fold(F.col("t_level")), F.lit("unknown")), roles.infer_level(F.col("t_text"))))
    df = salary.normalized(df, F.col("t_low"), F.col("t_high"), F.col("t_currency"), F.col("t_period"), F.col("t_pay"))
    paths = F.filter(F.array(*(F.struct(F.lit(n).alias("key"), F.col(f"p_{n}").alias("value")) for n in traced)), lambda x: x["value"].isNotNull())
    none = F.array().cast("array<string>")
    t = lambda n: F.col(f"t_{n}")
    return df.select(
        "source", "external_id", "raw_hash", "scraped_at", t("title").alias("title"), t("slug").alias("slug"), t("company").alias("company"), t("category").alias("category"),
        roles.location(t("city"), t("region"), t("country"), t("place"), F.col("work_type") == "remote").alias("location"), "salary",
        roles.employment_type(t("kinds")).alias("employment_type"), "work_type", "experience_level", t("description").alias("description"), t("needs").alias("requirements"),
        F.coalesce(F.array_distinct(F.array_compact("t_names")), none).alias("skills"), dates.absolute(t("posted")).alias("posted_at"), dates.absolute(t("updated")).alias("source_updated_at"),
        dates.posted_label(t("posted"), t("label")).alias("posted_label"), "status", F.map_from_entries(paths).alias("provenance"),
    )
