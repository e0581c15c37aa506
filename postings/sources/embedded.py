"""JSON inside pages and free texts: the script of a page, a key of it, the first value of a text."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The tag that begins a page's data, and the word after which a reply's value is looked for first.
PAGE_DATA, REPLY = '<script id="__NEXT_DATA__" type="application/json">', "RESPONSE"

_DECODER = json.JSONDecoder()
_OPEN = re.compile(r"[\[{]")


def script_json(html: Column, marker: str = PAGE_DATA) -> Column:
    """(json, reason): the text between a marker and the end of its script, or why there is none: missing, unterminated, not_json."""
    rest = F.when(F.contains(html, F.lit(marker)), F.substr(html, F.locate(marker, html) + len(marker)))
    text = F.when(F.contains(rest, F.lit("</script>")), F.trim(F.substring_index(rest, "</script>", 1)))
    good = F.try_parse_json(text).isNotNull()
    reason = F.when(rest.isNull(), "missing").when(text.isNull(), "unterminated").when(~good, "not_json")
    return F.struct(F.when(good, text).alias("json"), reason.alias("reason"))


def first_value(text: str | None) -> str | None:
    """The first JSON object or array of a text, after the reply's word if it has one; null if there is none."""
    at = -1 if text is None else text.find(REPLY)
    for start in ([at + len(REPLY)] if at >= 0 else []) + ([0] if text else []):
        for m in _OPEN.finditer(text, start):
            try:
                return text[m.start() : _DECODER.raw_decode(text, m.start())[1]]
            except json.JSONDecodeError:
                continue
    return None


def first_json(c: Column) -> Column:
    """``first_value`` of a text column in Arrow batches: no regular expression can tell where a value ends."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(first_value, na_action="ignore").astype(object)

    return run(c)
