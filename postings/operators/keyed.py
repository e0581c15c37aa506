"""Latest, first and upserted rows of a key, duplicates, chunks and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.operators import ranks


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by ``order`` (a total order: end it with an id).

    An aggregate, not a window: rows are combined before the shuffle, so a key with very many
    rows costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return df.groupBy(*keys).agg(best).select(*keys, "r.*").select(*df.columns)


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is first by ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("r")
    return df.groupBy(*keys).agg(best).select(*keys, "r.*").select(*df.columns)


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str], keep: list[str] | None = None) -> DataFrame:
    """``stored`` with the latest incoming row of each key in its place; ``keep`` columns stay as stored.

    One aggregation over both sides: incoming rows win over stored ones, later over earlier.
    """
    new, row, *kept = ranks.unused(stored, "new", "row", *(f"old_{c}" for c in keep or []))
    both = stored.withColumn(new, F.lit(0)).unionByName(incoming.withColumn(new, F.lit(1)))
    rest = [c for c in stored.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(new, *order)).alias(row)
    old = dict(zip(keep or [], kept, strict=True))
    first = [F.min_by(F.when(F.col(new) == 0, F.col(c)), F.col(new)).alias(n) for c, n in old.items()]
    out = both.groupBy(*keys).agg(best, *first)
    columns = [F.coalesce(old[c], F.col(row)[c]).alias(c) if c in old else (F.col(c) if c in keys else F.col(row)[c].alias(c)) for c in stored.columns]
    return out.select(*columns)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, their rows and surplus."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1").withColumn("surplus", F.col("n_rows") - 1)


def dedup_decisions(df: DataFrame, key: str, order: list[str], slug: str, title: str, company: str, fallback: Column | None = None) -> DataFrame:
    """``df`` with ``action`` and ``reason``: the first of a key is inserted, later ones update it.

    A later row is compared with the one before it: a changed slug is a drift, a changed slug,
    title and company together a collision. A null key is quarantined. No task holds
    a key's rows: its parts are compared with the last row of the part before.
    """
    known, missing = df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
    *names, later = ranks.unused(df, "last_slug", "last_title", "last_company", "later")
    old = dict(zip((slug, title, company), names, strict=True))
    known = ranks.with_previous(known, [key], order, old, later)
    last = {c: F.col(n) for c, n in old.items()}
    slug_changed = (last[slug] != F.col(slug)) & (last[slug] != "") & (F.col(slug) != "")
    text_changed = ~last[title].eqNullSafe(F.col(title)) & ~last[company].eqNullSafe(F.col(company))
    first = ~F.col(later)
    fresh = F.when(fallback, "fallback_fingerprint").otherwise("new_identity") if fallback is not None else F.lit("new_identity")
    reason = F.when(first, fresh).when(slug_changed & text_changed, "identity_collision").when(slug_changed, "slug_drift").otherwise("duplicate_identity")
    decided = known.withColumns({"action": F.when(first, "insert").otherwise("update"), "reason": reason}).drop(later, *names)
    return decided.unionByName(missing.withColumns({"action": F.lit("quarantine"), "reason": F.lit("missing_identity")}))


def chunks(df: DataFrame, scope: list[str], order: list[str], size: int) -> DataFrame:
    """``df`` with the number of its chunk of ``size`` rows inside the scope; no task holds a scope."""
    place, = ranks.unused(df, "place")
    return ranks.numbered(df, scope, order, place).withColumn("chunk", F.floor((F.col(place) - 1) / size)).drop(place)


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Rows of one page; offset and limit stay inside Spark's top-k operator."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_meta(df: DataFrame, number: int, size: int) -> DataFrame:
    """Rows, pages and whether there is a next and a previous page."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    pages = F.ceil(F.col("total") / size)
    return total.select("total", pages.alias("pages"), (pages > number).alias("has_next"), F.lit(number > 1).alias("has_previous"))


def top_values(df: DataFrame, keys: list[str], value: str, order: list[str], most: int) -> DataFrame:
    """The ``most`` frequent values of each key, ties by first appearance, then by value."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("at"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "at", value))
    return counted.withColumn("place", place).where(F.col("place") <= most).drop("at")
