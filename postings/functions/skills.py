"""Skill and requirement chains: canonical skills, split skill values, fallbacks, items, summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions import html, requirements
from postings.functions.text import clean, first_by, is_placeholder, once, without_noise

#: Names of skills, which stand for their own lower-case spelling, and the spellings that differ.
NAMES = (
    "Python", "Java", "JavaScript", "TypeScript", "Go", "PHP", "Ruby", "Kotlin", "Swift", "Rust", "C++", "C#", "SQL", "PostgreSQL", "MySQL", "MariaDB", "MongoDB", "Redis", "Oracle",
    "Docker", "Kubernetes", "Terraform", "Ansible", "Linux", "Git", "Node.js", "React", "Vue", "Angular", "Next.js", "Nuxt.js", "Laravel", "Django", "Flask", "FastAPI", "Spring",
    "Spring Boot", "Express.js", "AWS", "GCP", "Azure", "REST API", "GraphQL", "CI/CD", "Microservices",
)
SPELLINGS = {
    "golang": "Go", "postgres": "PostgreSQL", "node": "Node.js", "react.js": "React", "vue.js": "Vue", "next": "Next.js", "nuxt": "Nuxt.js", "express": "Express.js",
    "restful api": "REST API", "microservice": "Microservices",
}
#: The skill that a role stands for when a listing names none, tried in this order.
ROLE_SKILLS = {
    r"(?i)\b(engineer|developer|programmer|software|backend|frontend|full stack)\b": "Programming",
    r"(?i)\b(sales|business development|account executive|telemarketing)\b": "Negotiation",
    r"(?i)\b(marketing|brand|content|social media|seo|sem)\b": "Digital Marketing",
    r"(?i)\b(customer service|customer support|helpdesk|call center)\b": "Customer Service",
    r"(?i)\b(finance|accounting|akuntan|tax|auditor)\b": "Financial Analysis",
    r"(?i)\b(hr|recruiter|talent acquisition|people)\b": "Interpersonal Communication",
    r"(?i)\b(operation|logistic|warehouse|supply chain)\b": "Operations Management",
    r"(?i)\b(product manager|product owner|project manager)\b": "Project Management",
}
ANY_SKILL = "Effective Communication"
#: What separates skills, and skills that say nothing.
SKILL_MARKS, SKILL_SPLIT = r",|/|;|\||&| and | \+ ", r"(?i)\s*(?:,|/|;|\||\band\b|&)\s*|\s+\+\s+"
EMPTY_SKILLS, SKILL_NUMBER = ("keterampilan", "kemampuan", "keahlian", "soft skill", "soft skills", "hard skill", "hard skills"), r"(?i)^[a-z]{2,24}_[0-9]{2,}$"
EMPTY_STARTS = r"^(keterampilan|kemampuan|keahlian) "
#: Requirements that say nothing, whole, in part, by their start or end; fewest tokens of others is three.
EMPTY_WHOLE = ("mempunyai kesempatan jenjang karir", "kesempatan jenjang karir", "the most integrated agrochemical company", "career growth opportunities")
EMPTY_PARTS = (
    r"perusahaan ini adalah|menghasilkan produk berkualitas|telah terdaftar di komisi pestisida|sertifikasi iso 9001|integrated agrochemical company|"
    r"lingkungan kerja yang dinamis|kesempatan berkembang|peluang pengembangan karir|berorientasi pada kepuasan pelanggan"
)
EMPTY_BEGIN, EMPTY_END, TOKEN, FEWEST = r"^(kesempatan |lingkungan |budaya kerja )", r"(yang dinamis|yang baik)$", r"[A-Za-z0-9+#.]+", 3
#: Headings that begin a new item.
HEADINGS = r"(?i)\b(Kualifikasi|Persyaratan|Requirements?|Qualifications?|Tugas dan Tanggung Jawab)\s*:"
#: Most fallback items of a description, most items and skills of a summary, most relations of a listing.
FALLBACK_MOST, SUMMARY_MOST, RELATIONS_MOST = 8, 6, 100

_same = lambda names: F.create_map(*(F.lit(x) for pair in names.items() for x in pair))


def canonical(term: Column) -> Column:
    """The name of a skill by its spelling in any case, null if it isn't known."""
    return F.try_element_at(_same({n.lower(): n for n in NAMES} | SPELLINGS), F.lower(F.trim(term)))


def canonical_terms(c: Column) -> Column:
    """Distinct names of the tech terms of a text, in order; null text has none."""
    return F.coalesce(F.array_distinct(F.array_compact(F.transform(requirements.tech_terms(c), canonical))), F.array().cast("array<string>"))


def _once(values: Column) -> Column:
    return first_by(F.filter(values, lambda x: F.coalesce(x, F.lit("")) != ""), F.lower)


def split_skills(c: Column) -> Column:
    """Skills of one value, which may hold several between commas, slashes, "and" and the like."""
    parts = F.filter(F.transform(F.split(c, SKILL_SPLIT), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(~c.rlike(SKILL_MARKS), F.array(c)).otherwise(once(parts, lambda p: F.when(F.size(p) == 0, F.array(c)).otherwise(p)))


def is_skill(c: Column) -> Column:
    """Whether a cleaned value can be a skill: no placeholder, number code or empty phrase, 2 to 80 characters."""
    bare = F.btrim(F.lower(c), F.lit(" ."))
    empty = bare.isin(*EMPTY_SKILLS) | bare.rlike(EMPTY_STARTS) & (F.length(bare) < 24)
    return F.coalesce(~is_placeholder(c) & ~c.rlike(SKILL_NUMBER) & ~empty & F.length(c).between(2, 80), F.lit(False))


def sanitised_skills(values: Column) -> Column:
    """Skills of an array of values: split, held to ``is_skill``, followed by the value's canonical tech terms; first spelling of each kept."""
    one = lambda v: F.concat(F.filter(split_skills(v), is_skill), canonical_terms(v))
    return _once(F.flatten(F.transform(F.filter(F.transform(values, clean), lambda v: v.isNotNull()), one)))


def fallback_skills(title: Column, wanted: Column, description: Column) -> Column:
    """Up to 8 canonical terms of a listing's texts, else the skill that its role stands for."""
    joined = F.concat_ws(" ", title, wanted, description)
    role = F.lit(ANY_SKILL)
    for pattern, skill in reversed(ROLE_SKILLS.items()):
        role = F.when(joined.rlike(pattern), skill).otherwise(role)
    terms = canonical_terms(F.concat_ws("\n", title, wanted, description))
    return F.when(F.size(terms) > 0, F.slice(terms, 1, FALLBACK_MOST)).otherwise(F.array(role))


def first_filled(*arrays: Column) -> Column:
    """The first array that isn't empty or null."""
    return F.coalesce(*(F.when(F.size(a) > 0, a) for a in arrays))


def is_low_signal(c: Column) -> Column:
    """Whether a requirement says too little: an empty phrase, or one or two tokens that aren't a tech term."""
    short = (F.regexp_count(c, F.lit(TOKEN)) < FEWEST) & ~F.trim(c).rlike(f"^(?:{requirements.TECH})$")

    def empty(bare: Column) -> Column:
        phrase = bare.isin(*EMPTY_WHOLE) | bare.rlike(EMPTY_PARTS) | bare.rlike(EMPTY_BEGIN)
        return bare.isNull() | phrase | bare.rlike(EMPTY_END) & (F.size(F.split(bare, " +")) <= 6)

    return once(F.btrim(F.lower(clean(c)), F.lit(" .")), empty) | short


def items(c: Column) -> Column:
    """Requirements of a text: tags and headings off, split at lines, bullets, sentence ends and long comma lists, without noise and low signal.

    A comma list is split if it has two commas and 120 characters at least.
    """
    text = F.regexp_replace(F.regexp_replace(without_noise(c), "<[^>]+>", " "), "•| - ", "\n")
    text = F.regexp_replace(F.regexp_replace(text, HEADINGS, "\n"), r"([.;:])\s+|(?:^|\s)[-*]\s+", "$1\n")
    parts = F.split(text, r"\n+")
    long = lambda x: (F.regexp_count(x, F.lit(",")) >= 2) & (F.length(x) >= 120)
    parts = F.flatten(F.transform(parts, lambda x: F.when(long(x), F.split(x, ",")).otherwise(F.array(x))))
    kept = F.filter(F.transform(parts, lambda x: clean(F.regexp_replace(x, r"^\s*[-*]\s+", ""))), lambda x: x.isNotNull() & ~is_low_signal(x) & ~requirements.is_noise(x))
    return _once(F.transform(kept, lambda x: F.rtrim(x, F.lit("."))))


def typed(values: Column) -> Column:
    """Structs (type, value) of requirements; of equal type and value the first spelling stays, RELATIONS_MOST at most."""
    both = F.transform(values, lambda x: F.struct(requirements.requirement_class(x).alias("type"), x.alias("value")))
    return F.slice(first_by(both, lambda x: F.concat_ws(" ", x["type"], F.lower(F.trim(x["value"])))), 1, RELATIONS_MOST)


def fallback_requirements(title: Column, wanted: Column, described: Column) -> Column:
    """Requirements of a listing by its items ``wanted``, else the first 8 ``described``, else a sentence from its title."""
    sentence = F.concat(F.lit("Has core competencies relevant to the "), title, F.lit(" role."))
    return typed(first_filled(wanted, F.slice(described, 1, FALLBACK_MOST), F.array(sentence)))


def summary(wanted: Column, skills: Column) -> Column:
    """Display HTML of up to 6 items: a sentence or a list; without items a sentence of skills, without either null."""
    bullets = lambda few: F.array_join(F.transform(few, lambda x: F.concat(F.lit("- "), x)), "\n")
    named = once(skills, lambda s: F.when(F.size(s) > 0, F.concat(F.lit("Proficient in "), F.array_join(F.slice(s, 1, SUMMARY_MOST), ", "), F.lit("."))))
    text = lambda few: F.when(F.size(few) == 1, F.concat(F.get(few, 0), F.lit("."))).when(F.size(few) > 1, bullets(few)).otherwise(named)
    return html.display(once(F.slice(wanted, 1, SUMMARY_MOST), text))


def enrichment(skills: Column, requirements_: Column, *, skill_confidence: float = 0.6, requirement_confidence: float = 0.5) -> Column:
    """Rows (kind, type, value, confidence) that stand for a model's answer: skills first, then typed requirements."""
    row = lambda kind, t, v, n: F.struct(F.lit(kind).alias("kind"), t.alias("type"), v.alias("value"), F.lit(n).alias("confidence"))
    a = F.transform(skills, lambda s: row("skill", F.lit("SKILL"), s, skill_confidence))
    return F.concat(a, F.transform(requirements_, lambda r: row("requirement", r["type"], r["value"], requirement_confidence)))

