"""Text columns: cleaning, counting, language and keyword signals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for "nothing given".
PLACEHOLDERS = ("-", "--", "n/a", "na", "none", "null", "unknown", "tidak tersedia", "not available")
#: Words that tell Indonesian from English.
ID_TOKENS = ("dan", "yang", "untuk", "pengalaman", "kualifikasi", "dengan", "minimal")
EN_TOKENS = ("and", "with", "experience", "requirements", "ability", "team")
#: Substrings of which two make a text Indonesian.
ID_MARKERS = ("dan", "dengan", "pengalaman", "kualifikasi", "minimal", "menguasai", "mampu", "lulusan", "sarjana", "tahun", "bulan", "lokasi", "indonesia")
#: White space as Python sees it; Java's plain \s leaves out NBSP and others.
SPACE = r"(?U)\s+"


def clean(c: Column) -> Column:
    """Inner white space collapsed, ends trimmed, empty as null."""
    return F.nullif(F.trim(F.regexp_replace(c, SPACE, " ")), F.lit(""))


def is_placeholder(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(*PLACEHOLDERS)


def clean_description(c: Column) -> Column:
    text = clean(c)
    return F.when(~is_placeholder(text), text)


def export_text(c: Column) -> Column:
    """Text of an export: null as empty, trimmed."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "), SPACE, " "))


def paragraph_count(c: Column, plain: Column | None = None) -> Column:
    """Parts between sentence ends of the tag-free text (newlines are gone by then), given as ``plain`` if it is known."""
    parts = F.split(strip_tags(c) if plain is None else plain, r"[\n\r]+|[.!?]\s+")
    return F.size(F.filter(parts, lambda p: F.trim(p) != "")).cast("long")


def word_count(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"(?U)\S+")).cast("long")


def token_estimate(c: Column, words: Column | None = None) -> Column:
    """1.35 tokens a word, one at least, none for an empty text; halves round to even."""
    return F.when(F.coalesce(c, F.lit("")) == "", 0).otherwise(F.greatest(F.lit(1), F.bround((word_count(c) if words is None else words) * F.lit(1.35)))).cast("long")


def _hits(padded: Column, tokens: tuple[str, ...]) -> Column:
    total = F.lit(0)
    for t in tokens:
        total = total + F.contains(padded, F.lit(f" {t} ")).cast("int")
    return total


def language_signal(description: Column, summary: Column) -> Column:
    """ID, EN, MIXED or UNKNOWN by whole marker words."""
    text = F.lower(F.concat_ws(" ", strip_tags(description), strip_tags(summary)))
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    id_hits, en_hits = _hits(padded, ID_TOKENS), _hits(padded, EN_TOKENS)
    return F.when((id_hits > 0) & (en_hits > 0), "MIXED").when(id_hits > 0, "ID").when(en_hits > 0, "EN").otherwise("UNKNOWN")


def looks_indonesian(c: Column) -> Column:
    total = F.lit(0)
    for m in ID_MARKERS:
        total = total + F.contains(F.lower(c), F.lit(m)).cast("int")
    return total >= 2


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]{3,}"), F.lit(0))


def keywords(*columns: Column, most: int = 50) -> Column:
    """Sorted distinct ASCII tokens of three characters or more."""
    return F.slice(F.sort_array(F.array_distinct(_tokens(F.concat_ws(" ", *columns)))), 1, most)


def role_keywords(title: Column, most: int = 30) -> Column:
    return F.slice(_tokens(title), 1, most)


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``c``, which is worked out once however often ``use`` mentions it (a Column in place of each mention would be as many copies)."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def first_by(values: Column, key: Callable[[Column], Column]) -> Column:
    """Array without later elements of a key already seen; the first spelling stays. Keys must not be null.

    By sorting (key, place), so the work is n log n: no element is looked up in the whole array.
    """
    s = F.sort_array(F.transform(values, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))))
    before = lambda s: F.concat(F.array(F.lit(None).cast("string")), F.transform(s, lambda e: e["k"]))
    firsts = once(s, lambda s: F.zip_with(s, before(s), lambda e, k: F.when(e.isNotNull() & ~e["k"].eqNullSafe(k), F.struct(e["i"].alias("i"), e["x"].alias("x")))))
    return F.transform(F.sort_array(F.filter(firsts, lambda e: e.isNotNull())), lambda e: e["x"])


def text_quality(description: Column, summary: Column, plain: bool = False) -> Column:
    """Points for texts of some length, tags aside; ``plain`` texts have none."""
    a, b = (c if plain else strip_tags(c) for c in (description, summary))
    a = F.when(F.length(a) >= 80, 7).otherwise(0)
    b = F.when(F.length(b) >= 20, 3).otherwise(0)
    return ((a + b) * 10).cast("int")


def has_legacy_heading(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?i)^\s*(?:<p>\s*)?(kualifikasi utama|kualifikasi|persyaratan)\s*:\s*")


def without_noise(c: Column) -> Column:
    """Emoji, dingbats and zero-width characters removed."""
    return F.regexp_replace(c, r"[\x{2600}-\x{27BF}\x{1F300}-\x{1FAFF}\x{200B}-\x{200F}\x{2060}\x{FE0E}\x{FE0F}]", "")
