"""Captured list pages of five sources parsed to raw rows, bad envelopes and rows set aside."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Envelope:
    """Where a source keeps its rows, and what must be there."""

    rows: str
    required: tuple[str, ...] = ()
    numeric_id: bool = False
    needs_flag: str | None = None
    rejects: str | None = None


#: The envelope of each source's list page.
ENVELOPES = {
    "source_a": Envelope("$.data.docs"),
    "source_b": Envelope("$.data.searchJobsV3.jobsInPage", needs_flag="$.data.searchJobsV3.hasMore", rejects="$.errors"),
    "source_c": Envelope("$.data.jobSearchV6.data"),
    "source_d": Envelope("$.pageProps.jobs", numeric_id=True),
    "source_e": Envelope("$.data.vacanciesV4.list", required=("slug", "positionName", "company.name")),
}


def parse_pages(pages: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of pages(page_id, payload): a row for each list entry with an id, the rest with a reason.

    rows: source, page_id, position, external_id, payload; rejects: source, page_id, position,
    reason. Nothing is dropped: every page or entry is in exactly one of the two. The payload
    is parsed once, as a variant.
    """
    e = ENVELOPES[source]
    v = pages.select("page_id", F.try_parse_json("payload").alias("v"))
    entries = F.try_variant_get("v", e.rows, "array<variant>")
    bad = F.when(F.col("v").isNull(), "not_json")
    if e.rejects:
        bad = bad.when(F.try_variant_get("v", e.rejects, "string").isNotNull(), "source_errors")
    bad = bad.when(entries.isNull(), "missing_list")
    if e.needs_flag:
        bad = bad.when(F.try_variant_get("v", e.needs_flag, "boolean").isNull(), "missing_flag")
    v = v.select("page_id", entries.alias("entries"), bad.alias("bad"))
    rows = v.where("bad is null").select("page_id", F.posexplode("entries").alias("position", "entry"))
    kind = F.schema_of_variant(F.try_variant_get("entry", "$.id", "variant"))
    text = F.try_variant_get("entry", "$.id", "string")
    known = kind.isin("STRING", "BIGINT") if e.numeric_id else kind == "STRING"
    ok = F.coalesce(known & (F.trim(text) != ""), F.lit(False))
    lacks = F.lit(False)
    for name in e.required:
        lacks = lacks | (F.coalesce(F.trim(F.try_variant_get("entry", f"$.{name}", "string")), F.lit("")) == "")
    rows = rows.select(F.lit(source).alias("source"), "page_id", "position", text.alias("external_id"), F.to_json("entry").alias("payload"), F.when(~ok, "missing_id").when(lacks, "missing_field").alias("reason"))
    pages_out = v.where("bad is not null").select(F.lit(source).alias("source"), "page_id", F.lit(None).cast("int").alias("position"), F.col("bad").alias("reason"))
    rejects = pages_out.unionByName(rows.where("reason is not null").select("source", "page_id", "position", "reason"))
    return rows.where("reason is null").drop("reason"), rejects


def balanced_object(text: str, start: int) -> str | None:
    """The JSON object that opens at or after ``start``, braces in strings not counted."""
    begin = text.find("{", start)
    depth, quoted, i = 0, False, begin
    while 0 <= i < len(text):
        ch = text[i]
        if quoted:
            if ch == "\\":
                i += 1
            elif ch == '"':
                quoted = False
        elif ch == '"':
            quoted = True
        elif ch in "{}":
            depth += 1 if ch == "{" else -1
            if depth == 0:
                return text[begin : i + 1]
        i += 1
    return None


def embedded_json(df: DataFrame, html: str, marker: str, key: str) -> DataFrame:
    """(key, json): the object after a marker in each page; null where there is none. No regex can count braces."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [balanced_object(t, t.find(marker) + len(marker)) if isinstance(t, str) and marker in t else None for t in pdf[html]]
            yield pd.DataFrame({key: pdf[key], "json": pd.Series(found, dtype=object)})

    return df.select(key, html).mapInPandas(run, f"{key} {kind}, json string")


def source_url(url: str = "url"):
    """A URL without its query."""
    return F.split(F.col(url), r"\?")[0]
