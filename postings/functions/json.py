"""JSON columns: canonical text and hash, searches and cuts at any depth."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TRACKING = re.compile(r"(trace|tracking|queryid|query_id|solid|sol_id)", re.IGNORECASE)
SECRET_KEY = re.compile(r"(authorization|bearer|cookie|csrf|token|secret|credential|password|session|visitor|device|database_?url|db_?url|api_?key)", re.IGNORECASE)
REDACTED = "<redacted>"


def canonical_struct(fields: dict[str, Column]) -> Column:
    """JSON text of fields in name order, nulls kept."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def struct_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_struct(fields), 256)


def _each(c: Column, work: Callable[[Any], Any], kind: str) -> Column:
    """``work`` on each parsed value, by Arrow batches; null and invalid JSON stay null."""

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            out = []
            for text in series:
                try:
                    out.append(None if text is None else work(json.loads(text)))
                except ValueError:
                    out.append(None)
            yield pd.Series(out, dtype=object)

    return run(c)


def canonical_text(c: Column) -> Column:
    """Any JSON with sorted keys and no spaces."""
    return _each(c, lambda v: json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False), "string")


def payload_hash(c: Column) -> Column:
    return F.sha2(canonical_text(c), 256)


def find_key(c: Column, names: tuple[str, ...]) -> Column:
    """The first text or number under one of the keys, outermost first, tracking keys passed by."""

    def walk(value: Any) -> str | None:
        level = [value]
        while level:
            below = []
            for v in level:
                if isinstance(v, dict):
                    for n in names:
                        if isinstance(v.get(n), (str, int)) and not isinstance(v.get(n), bool):
                            return str(v[n])
                    below += [x for k, x in v.items() if not TRACKING.search(k)]
                elif isinstance(v, list):
                    below += v
            level = below
        return None

    return _each(c, walk, "string")


def shrink(c: Column, most: int) -> Column:
    """Lists at any depth cut to their first ``most`` elements."""

    def cut(v: Any) -> Any:
        if isinstance(v, list):
            return [cut(x) for x in v[:most]]
        return {k: cut(x) for k, x in v.items()} if isinstance(v, dict) else v

    return _each(c, lambda v: json.dumps(cut(v), sort_keys=True, separators=(",", ":")), "string")


def redact_keys(c: Column, items: int = 20, chars: int = 500) -> Column:
    """Values of secret keys replaced, lists and texts cut, at any depth."""

    def clean(v: Any) -> Any:
        if isinstance(v, dict):
            return {k: REDACTED if SECRET_KEY.search(k) else clean(x) for k, x in v.items()}
        if isinstance(v, list):
            return [clean(x) for x in v[:items]]
        return v[:chars] if isinstance(v, str) else v

    return _each(c, lambda v: json.dumps(clean(v), sort_keys=True, separators=(",", ":")), "string")


def has_text_under(c: Column, names: tuple[str, ...]) -> Column:
    """Whether a non-empty text stands under one of the keys at any depth."""

    def walk(v: Any) -> bool:
        if isinstance(v, dict):
            return any((k in names and isinstance(x, str) and bool(x.strip())) or walk(x) for k, x in v.items())
        return isinstance(v, list) and any(map(walk, v))

    return _each(c, walk, "boolean")


def gap_count(c: Column) -> Column:
    """Entries of a gaps value: a list, an object with a list ``gaps``, an object's keys, or one for a text."""
    v = F.try_parse_json(c)
    inner = F.size(F.try_variant_get(v, "$.gaps", "array<variant>"))
    keys = F.size(F.json_object_keys(c))
    plain = F.when(F.coalesce(F.trim(c), F.lit("")) == "", 0).otherwise(1)
    kind = F.schema_of_variant(v)
    return F.when(v.isNull(), plain).when(kind.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>"))).when(kind.startswith("OBJECT"), F.coalesce(F.nullif(inner, F.lit(-1)), keys)).otherwise(plain).cast("int")
