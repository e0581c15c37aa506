"""Role, seniority, location and enum columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions.text import clean

#: Substrings of a title and its family, in the order they are tried.
FAMILIES = (
    ("engineering", ("engineer", "developer", "software", "backend", "frontend")),
    ("data_ai", ("data", "analyst", "science", "ml", "ai")),
    ("design", ("design", "ui", "ux", "product designer")),
    ("growth", ("marketing", "sales", "business development")),
)
TECH_TOKENS = ("python", "javascript", "sql", "data", "backend", "frontend", "engineer", "developer")
LEVELS = ("ENTRY_LEVEL", "JUNIOR", "MID_LEVEL", "SENIOR", "LEAD")
#: Words of a text and the level they tell, in the order they are tried.
LEVEL_WORDS = (
    ("lead", ("lead", "head", "principal", "manager", "owner role")),
    ("senior", ("senior",)),
    ("mid_level", ("mid level", "mid-level", "intermediate")),
    ("junior", ("junior",)),
    ("entry_level", ("fresh graduate", "fresh grad", "intern", "internship", "no experience")),
)


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(c, F.lit(w))
    return found


def ladder(c: Column, steps: tuple[tuple[str, tuple[str, ...]], ...], other: str | None) -> Column:
    """The name of the first step one of whose words the text contains."""
    found = F.when(c.isNull(), F.lit(other))
    for name, words in steps:
        found = found.when(contains_any(c, words), name)
    return found.otherwise(F.lit(other))


def role_family(c: Column) -> Column:
    return ladder(F.lower(c), FAMILIES, "other")


def is_tech(c: Column) -> Column:
    return contains_any(F.lower(c), TECH_TOKENS)


def seniority(level: Column) -> Column:
    return F.when(level.isin("ENTRY_LEVEL", "JUNIOR"), "entry").when(level == "MID_LEVEL", "mid").when(level.isin("SENIOR", "LEAD"), "senior").otherwise("unknown")


def seniority_number(level: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, LEVELS)), level), F.lit(0)), F.lit(0)).cast("int")


def level_text(*texts: Column) -> Column:
    """What ``infer_level`` reads; make it a column of its own first, since that uses it many times."""
    return F.lower(F.concat_ws(" ", *(clean(t) for t in texts)))


def infer_level(text: Column) -> Column:
    """Experience level of a lower-case text: words first, then years ("3 - 5", "5+ years"; [-to] is a character class)."""
    ranges = r"(\d+)\s*[-to]+\s*(\d+)\s*(tahun|years?)?"
    more = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)\s*\+\s*(tahun|years?)"), F.lit(1)), lambda x: x.cast("int"))
    numbers = lambda i: F.concat(F.transform(F.regexp_extract_all(text, F.lit(ranges), F.lit(i)), lambda x: x.cast("int")), more)
    low, high = F.array_min(numbers(1)), F.array_max(numbers(2))
    by_years = (
        F.when((low >= 3) & (high <= 5), "mid_level")
        .when((high >= 5) | (low >= 5), "senior")
        .when((high >= 3) | (low >= 3), "mid_level")
        .when((high >= 1) | (low >= 1), "junior")
        .otherwise("entry_level")
    )
    return F.coalesce(ladder(text, LEVEL_WORDS, None), by_years)


def fold(c: Column) -> Column:
    return F.translate(F.lower(clean(c)), "- ", "__")


def work_type(c: Column) -> Column:
    v = fold(c)
    return F.when(contains_any(v, ("remote", "work_from_home")) | (v == "wfh"), "remote").when(F.contains(v, F.lit("hybrid")), "hybrid").when(contains_any(v, ("onsite", "on_site", "kantor")), "onsite").otherwise("unknown")


def employment_type(c: Column) -> Column:
    v = F.replace(F.replace(fold(c), F.lit("fulltime"), F.lit("full_time")), F.lit("parttime"), F.lit("part_time"))
    return (
        F.when(v.isin("full_time", "full"), "full_time").when(v.isin("part_time", "part"), "part_time").when(F.contains(v, F.lit("contract")), "contract")
        .when(F.contains(v, F.lit("intern")), "internship").when(F.contains(v, F.lit("freelance")), "freelance").otherwise("unknown")
    )


def job_status(c: Column) -> Column:
    v = F.lower(clean(c))
    return F.when(v.isin("active", "open"), "active").when(v == "stale", "stale").when(v.isin("inactive", "closed"), "inactive").when(v == "expired", "expired").otherwise("unknown")


def location(city: Column, region: Column, country: Column, display: Column, remote: Column) -> Column:
    """Location struct: missing parts from the display text, "Remote, Indonesia" for remote jobs there."""
    text = clean(display)
    parts = F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != "")
    town = F.coalesce(clean(city), F.nullif(F.trim(F.get(F.split(text, ","), F.lit(0))), F.lit("")))
    area = F.coalesce(clean(region), F.get(parts, F.lit(1)))
    land = clean(country)
    home = remote.eqNullSafe(True) & (F.lower(land) == "indonesia")
    town = F.when(home, F.coalesce(town, F.lit("Remote"))).otherwise(town)
    area = F.when(home, F.coalesce(area, F.lit("Indonesia"))).otherwise(area)
    shown = F.coalesce(text, F.nullif(F.concat_ws(", ", town, area, land), F.lit("")))
    return F.struct(town.alias("city"), area.alias("region"), land.alias("country"), shown.alias("display"))
