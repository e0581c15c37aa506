"""Identity keys, hashes and the deterministic split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions.text import clean

TRAIN_SHARE, VALIDATION_SHARE = 0.80, 0.10


def key_part(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))


def identity_key(source: Column, external_id: Column) -> Column:
    """source:id of the folded parts; null where one is missing."""
    a, b = key_part(source), key_part(external_id)
    return F.when((a != "") & (b != ""), F.concat_ws(":", a, b))


def identity_hash(key: Column) -> Column:
    return F.sha2(key, 256)


def fingerprint(source: Column, slug: Column, title: Column, company: Column, url: Column) -> Column:
    """Hash of five fields in a canonical JSON text, for rows without an external id; null without evidence."""
    platform = F.lower(clean(source))
    rest = {"company_name": clean(company), "source_platform": platform, "source_slug": clean(slug), "source_url": clean(url), "title": clean(title)}
    some = F.coalesce(rest["source_slug"], rest["title"], rest["company_name"], rest["source_url"]).isNotNull()
    text = F.to_json(F.struct(*(v.alias(k) for k, v in rest.items())), {"ignoreNullFields": "false"})
    return F.when(platform.isNotNull() & some, F.sha2(text, 256))


def unit_of(key: Column) -> Column:
    """A number in [0, 1] from the first 32 bits of the key's hash."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def split_of(key: Column) -> Column:
    u = unit_of(key)
    return F.when(u < TRAIN_SHARE, "train").when(u < TRAIN_SHARE + VALIDATION_SHARE, "validation").otherwise("test")
