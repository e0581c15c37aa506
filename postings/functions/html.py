"""HTML columns: tag-free text, safety and display form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions.text import SPACE, once

#: Tags that display HTML may have, and what makes HTML unsafe.
ALLOWED = ("p", "ul", "ol", "li", "strong", "em", "br")
UNSAFE = r"(?i)(?:<\s*/?\s*(?:script|style|iframe|object|embed|svg)\b|\bon[a-z]+\s*=|javascript\s*:)"
DROPPED = r"(?is)<(script|style|noscript|template|iframe|svg)\b[^>]*>.*?</\1\s*>"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def to_text(html: Column) -> Column:
    """Text of a page without scripts, styles and comments, white space collapsed."""
    out = F.regexp_replace(F.regexp_replace(html, DROPPED, " "), r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, "<[^>]+>", " ")
    for entity, to in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(to))
    return F.trim(F.regexp_replace(out, SPACE, " "))


def is_safe(html: Column) -> Column:
    """Only allowed tags, none with attributes, and nothing script-like."""
    tag = F.lit(r"<\s*/?\s*([a-zA-Z0-9]+)([^>]*)>")
    names = F.transform(F.regexp_extract_all(html, tag, F.lit(1)), F.lower)
    attributes = F.regexp_extract_all(html, tag, F.lit(2))
    return F.forall(names, lambda n: n.isin(*ALLOWED)) & F.forall(attributes, lambda a: F.trim(a) == "") & ~html.rlike(UNSAFE)


def display(text: Column) -> Column:
    """Plain text as a paragraph, or as a list when two lines or more are bullets."""
    lines = F.filter(F.transform(F.split(text, r"\n+"), lambda x: F.trim(x)), lambda x: x != "")
    bullets = lambda lines: F.filter(lines, lambda x: x.rlike(r"^[-*•]\s*"))
    escape = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = lambda x: F.concat(F.lit("<li>"), escape(F.regexp_replace(x, r"^[-*•]\s*", "")), F.lit("</li>"))
    listed = lambda lines: F.concat(F.lit("<ul>"), F.array_join(F.transform(lines, item), ""), F.lit("</ul>"))
    return once(lines, lambda x: F.when(F.size(bullets(x)) >= 2, listed(x)).when(F.size(x) > 0, F.concat(F.lit("<p>"), escape(F.array_join(x, " ")), F.lit("</p>"))))
