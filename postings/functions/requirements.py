"""Requirement and skill columns: splitting, noise, classes and tech terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions.text import first_by

#: Patterns that decide a requirement's type, tried in this order.
TECH = (
    r"(?i)\b(python|java(?:script)?|typescript|go(?:lang)?|php|ruby|kotlin|swift|rust|c\+\+|c#|sql|postgres(?:ql)?|mysql|mariadb|mongodb|redis|oracle|"
    r"docker|kubernetes|terraform|ansible|linux|git|node(?:\.js)?|react(?:\.js)?|vue(?:\.js)?|angular|next(?:\.js)?|nuxt(?:\.js)?|"
    r"laravel|django|flask|fastapi|spring(?: boot)?|express(?:\.js)?|aws|gcp|azure|rest(?:ful)?\s*api|graphql|ci/cd|microservices?)\b"
)
SKILL = r"(?i)\b(menguasai|mahir|proficient|familiar|keahlian|kompetensi|kemampuan\s+(?:teknis|analitis|komunikasi|problem solving))\b"
EDUCATION = r"(?i)\b(s1|s2|s3|d3|d4|sarjana|lulusan|degree|bachelor|master|computer science|ilmu komputer|teknik informatika|pendidikan)\b"
EXPERIENCE = r"(?i)\b(minimal|min\.?|minimum|pengalaman|experience|tahun|years|fresh graduate|freshgrad|junior|senior|lead)\b"
RESPONSIBILITY = (
    r"(?i)\b(bertanggung jawab|mengembangkan|mengelola|membangun|melakukan|membuat|memelihara|berkoordinasi|menjaga|mengoptimalkan|menyusun|"
    r"responsible for|developing|managing|building|performing|creating|maintaining|coordinating|optimizing|drafting)\b"
)
NOISE = r"(?i)\b(thr|tunjangan|benefit|benefits?|fasilitas|bonus|cuti|bpjs|gaji pokok|kompensasi|asuransi|uang makan|transport(?:asi)?)\b"


def requirement_class(c: Column) -> Column:
    return (
        F.when(c.rlike(TECH) | c.rlike(SKILL), "SKILL").when(c.rlike(EDUCATION), "EDUCATION").when(c.rlike(EXPERIENCE), "EXPERIENCE")
        .when(c.rlike(RESPONSIBILITY), "RESPONSIBILITY").otherwise("OTHER")
    )


def is_noise(c: Column) -> Column:
    return c.rlike(NOISE)


def split_items(c: Column) -> Column:
    """Items of a requirement text: lines, bullets and sentences; first spelling of each kept.

    A mark is set after sentence ends instead of looking behind, so any SQL engine can say it.
    """
    marked = F.regexp_replace(F.regexp_replace(c, "•| - ", "\n"), r"([.;:])\s+", "$1\n")
    items = F.transform(F.split(marked, r"\n+"), lambda x: F.trim(F.regexp_replace(x, r"^[-*]\s+", "")))
    return first_by(F.filter(items, lambda x: x != ""), F.lower)


def tech_terms(c: Column) -> Column:
    """Distinct tech terms of a text as they are written there, lower case, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(TECH), F.lit(1)), F.lower))
