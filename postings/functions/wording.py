"""Wording of listings: rewriting marks, grounding, limited summaries, countries, source names, missing context."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions import html
from postings.functions.text import SPACE, clean, without_noise

#: Words by which a sentence only tells that a text was rewritten.
META = (
    r"(?i)\b(deskripsi peran ini disusun ulang|deskripsi ini disusun ulang|ringkasan ini disusun ulang|ditulis ulang dalam bahasa indonesia|"
    r"this (?:role|job) description (?:is|has been) (?:rewritten|rephrased|translated)|rewritten in indonesian)\b"
)
#: Headings that a requirement summary may begin with, in this case only.
PREFIX = r"^(Kualifikasi utama|Kualifikasi|Persyaratan|Requirements?|Qualifications?)\s*:\s*"
#: Places that speak against the default country, and that country.
FOREIGN = (
    "singapore", "malaysia", "philippines", "thailand", "vietnam", "india", "china", "japan", "korea", "taiwan", "hong kong", "australia", "new zealand", "united states", "usa", "canada",
    "united kingdom", "uk", "germany", "france", "netherlands",
)
HOME = "Indonesia"
#: Source names that aren't their slug in title case.
SOURCE_NAMES = {"jobstreet": "JobStreet"}
GROUND_TOKEN = r"[a-z0-9+#.]+"


def without_meta(c: Column) -> Column:
    """Sentences and lines of a text that don't speak of its rewriting, one space apart; null if none is left."""
    parts = F.transform(F.split(F.regexp_replace(c, r"([.!?])\s+", "$1\n"), r"\n+"), lambda x: F.trim(x))
    kept = F.filter(parts, lambda x: (x != "") & ~x.rlike(META))
    return F.nullif(F.array_join(kept, " "), F.lit(""))


def without_prefix(c: Column) -> Column:
    """A requirement summary without its heading, never null."""
    return F.trim(F.regexp_replace(F.coalesce(clean(c), F.lit("")), PREFIX, ""))


def grounded(value: Column, source: Column) -> Column:
    """Whether a text holds a value, or every token of two characters or more of it, by lower-case tokens."""
    tokens = lambda c: F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(GROUND_TOKEN), F.lit(0))
    words = tokens(value)
    text, given = F.array_join(tokens(source), " "), F.array_join(words, " ")
    long = F.filter(words, lambda w: F.length(w) >= 2)
    return (given != "") & (F.contains(text, given) | (F.size(long) > 0) & F.forall(long, lambda w: F.contains(text, w)))


def limited_summary(title: Column, company: Column, location: Column, source: Column, language: str = "english") -> Column:
    """A sentence that tells what is known of a listing without details."""
    or_else = lambda c, other: F.coalesce(clean(c), F.lit(other))
    if language.strip().casefold() == "english":
        parts = [or_else(title, "Unknown position"), " at ", or_else(company, "unknown company"), " (", or_else(location, "location unavailable"), "). This summary is based on ",
                 or_else(source, "source"), " listing-level data; full details are unavailable."]
    else:
        parts = [or_else(title, "Posisi tidak diketahui"), " di ", or_else(company, "perusahaan tidak diketahui"), " (", or_else(location, "lokasi tidak tersedia"), "). Ringkasan ini dari data ",
                 or_else(source, "sumber"), " level listing; detail penuh tidak tersedia."]
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def home_country(country: Column, *places: Column) -> Column:
    """The given country, else the default one unless a place names another."""
    joined = F.lower(F.concat_ws(" ", *(clean(p) for p in places)))
    foreign = F.lit(False)
    for hint in FOREIGN:
        foreign = foreign | F.contains(joined, F.lit(hint))
    return F.coalesce(clean(country), F.when(~foreign, HOME))


def location_key(*parts: Column) -> Column:
    """Lower-case parts of a location between bars, blanks left out."""
    return F.concat_ws("|", *(F.lower(clean(p)) for p in parts))


def source_name(slug: Column) -> Column:
    """Display name of a source; unknown ones in title case."""
    name = F.lower(F.trim(slug))
    out = F.initcap(name)
    for known, shown in SOURCE_NAMES.items():
        out = F.when(name == known, shown).otherwise(out)
    return out


def missing_context(title: Column, description: Column, requirements: Column, skills: Column) -> Column:
    """Names of what a listing lacks: texts that are blank, arrays that are empty."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    lacks = {"title": blank(title), "description": blank(description), "requirements": none(requirements), "skills": none(skills)}
    return F.array_compact(F.array(*(F.when(bad, name) for name, bad in lacks.items())))


# fixed values: phrases and what they become, in the order in which they are applied ($1 is what the first brackets hold)
REWRITES = (
    (r"\bgelar sarjana\b", "bachelor's degree"), (r"\bsarjana\b", "bachelor's degree"), (r"\bdiploma\b", "diploma"), (r"\bminimum of\b", "minimum"), (r"\bminimal\b", "minimum"),
    (r"\bpreferably\b", "preferred"), (r"\blebih disukai\b", "preferred"), (r"\bstrong interest\b", "strong interest"), (r"\bminat kuat\b", "strong interest"),
    (r"\bstrong communication skills?\b", "strong communication skills"), (r"\blatar belakang di\b", "background in"), (r"\bbidang terkait\b", "related field"),
    (r"\bfresh graduates?\b", "fresh graduates"), (r"\blulusan baru\b", "fresh graduates"), (r"\bcandidates?\b", "candidates"), (r"\bkandidat\b", "candidates"),
    (r"\byears? of experience\b", "years of experience"), (r"\btahun pengalaman\b", "years of experience"), (r"\bexperience in\b", "experience in"), (r"\bpengalaman dalam\b", "experience in"),
    (r"\bpengalaman\b", "experience"), (r"\bmenguasai\b", "proficient in"), (r"\bmahir\b", "proficient in"), (r"\bmampu\b", "able to"), (r"\bbertanggung jawab\b", "responsible for"),
    (r"\bpendidikan\b", "education"), (r"\bmengembangkan\b", "developing"), (r"\bmengelola\b", "managing"), (r"\bmembangun\b", "building"), (r"\bmelakukan\b", "performing"),
    (r"\bmembuat\b", "creating"), (r"\bmemelihara\b", "maintaining"), (r"\bberkoordinasi\b", "coordinating"), (r"\bmenjaga\b", "maintaining"), (r"\bmengoptimalkan\b", "optimizing"),
    (r"\bmenyusun\b", "drafting"), (r"\bexperience\s*:\s*", "Experience: "), (r"\bkategori\s*:\s*", "Category: "), (r"\bcategory\s*:\s*", "Category: "), (r"\bkeahlian\s*:\s*", "Skills: "),
    (r"\bskills?\s*:\s*", "Skills: "), (r"\bminimal\s+(\d+)\s+tahun\b", "minimum $1 years"), (r"\bminimum\s+(\d+)\s+years?\b", "minimum $1 years"), (r"\bhingga\s+(\d+)\s+tahun\b", "up to $1 years"),
    (r"\bup to\s+(\d+)\s+years?\b", "up to $1 years"), (r"\b(\d+)\s*-\s*(\d+)\s+tahun\b", "$1-$2 years"), (r"\b(\d+)\s*-\s*(\d+)\s+years?\b", "$1-$2 years"), (r"\btahun\b", "years"), (r"\bdan\b", "and"),
    (r"\bdengan\b", "with"), (r"\buntuk\b", "for"), (r"\byang\b", "that"),
)


def block(c: Column) -> Column:
    """Text of a block: tags as text, decoration away, bullets and dashes between spaces as sentence ends; null if nothing is left."""
    plain = F.when(c.rlike("<[^>]+>"), html.to_text(c)).otherwise(c)
    bare = clean(F.translate(without_noise(plain), "▪◦", "  "))
    return clean(F.replace(F.replace(bare, F.lit("•"), F.lit(". ")), F.lit(" - "), F.lit(". ")))


def rewritten(c: Column) -> Column:
    """Phrases of requirements in one wording: each rewrite on what the ones before it left, white space collapsed.

    One search for any of the phrases comes first: a text that holds none isn't gone over again.
    """
    out = c
    for pattern, to in REWRITES:
        out = F.regexp_replace(out, f"(?i){pattern}", to)
    found = c.rlike("(?i)" + "|".join(pattern for pattern, _ in REWRITES))
    return F.trim(F.regexp_replace(F.when(found, out).otherwise(c), SPACE, " "))
