"""Run, page and work-item operators: coverage, merged summaries, worst status, ready work, set differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.operators.ranks import unused

from postings.functions.text import first_by

#: Stage statuses from worst to best, and the retry limit of a work item.
WORST_FIRST, MAX_ATTEMPTS = ("failed", "partial", "completed"), 3
#: Stage, code and whether a repeat may help, for each class of error.
ERRORS = {
    "fetch": ("FETCH_ERROR", True), "config": ("CONFIG_ERROR", False), "parse": ("PARSE_ERROR", False),
    "normalize": ("NORMALIZE_ERROR", False), "persist": ("PERSIST_ERROR", True), "sync": ("SYNC_ERROR", True),
}


def keyword_list(c: Column) -> Column:
    """Keywords of a comma-separated text: trimmed, blanks left out, first spelling of each kept."""
    return first_by(F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != ""), F.lower)


def since(c: Column, zone: str) -> Column:
    """An ISO-8601 text as an instant; one without an offset is read in ``zone`` (the session's zone must be UTC)."""
    at = F.try_to_timestamp(c)
    return F.when(F.trim(c).rlike(r"(Z|[+-]\d\d:?\d\d)$"), at).otherwise(F.to_utc_timestamp(at, zone))


def error_class(stage: Column, retryable: Column | None = None) -> Column:
    """(stage, category, retryable) of an error; what the error says of itself overrides its class's retryable flag."""
    code, again = F.lit("SCRAPER_ERROR"), F.lit(False)
    for name, (category, repeat) in ERRORS.items():
        code, again = F.when(stage == name, category).otherwise(code), F.when(stage == name, repeat).otherwise(again)
    again = again if retryable is None else F.coalesce(retryable, again)
    return F.struct(stage.alias("stage"), code.alias("category"), again.alias("retryable"))


def response_summary(status: Column, errors: Column, most: int = 10) -> Column:
    """(status_class, n_errors, errors): the class of a response status and its first ``most`` validation errors."""
    kind = F.when(status.isNull(), "transport").otherwise(F.concat(F.floor(status / 100).cast("string"), F.lit("xx")))
    return F.struct(kind.alias("status_class"), F.coalesce(F.size(errors), F.lit(0)).alias("n_errors"), F.slice(errors, 1, most).alias("errors"))


def ordered_difference(every: Column, some: Column) -> Column:
    """Entries of an array that another one lacks, order and repeats kept."""
    return F.filter(every, lambda x: ~F.array_contains(some, x))


def ready_work(items: DataFrame, kind: str, now: Column, order: list[str], limit: int, *, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The first ``limit`` items (type, status, available_at, attempts) of a type that may be worked on now."""
    fit = (F.col("type") == kind) & F.col("status").isin("pending", "failed") & (F.col("available_at") <= now) & (F.col("attempts") < max_attempts)
    return items.where(fit).orderBy(*order).limit(limit)


def work_state(ok: Column, attempts: Column, at: Column, delay: Column, *, max_attempts: int = MAX_ATTEMPTS) -> Column:
    """(status, available_at) after an attempt: completed, failed until the delay is over, or dead-letter."""
    status = F.when(ok, "completed").when(attempts >= max_attempts, "dead-letter").otherwise("failed")
    return F.struct(status.alias("status"), F.when(status == "failed", at + delay).alias("available_at"))


def open_quarantine(rows: DataFrame, source: str | None, order: list[str]) -> DataFrame:
    """Unresolved quarantine rows (source, resolved_at), of one source or all, oldest first."""
    found = rows.where("resolved_at is null")
    return (found if source is None else found.where(F.col("source") == source)).orderBy(*order)


def select_sources(sources: DataFrame, config: DataFrame) -> DataFrame:
    """``sources`` (source) with selected and why not, by config (source, enabled, requested)."""
    row = sources.join(config, "source", "left")
    reason = F.when(F.col("enabled").isNull(), "unknown_source").when(~F.col("requested"), "not_requested").when(~F.col("enabled"), "disabled")
    return row.select("source", reason.isNull().alias("selected"), reason.alias("reason"))


def worst_status(stages: DataFrame, by: list[str], status: Column) -> DataFrame:
    """The worst stage status of each run; unknown ones count as completed."""
    rank = F.least(*(F.when(status == s, i).otherwise(len(WORST_FIRST) - 1) for i, s in enumerate(WORST_FIRST)))
    return stages.groupBy(*by).agg(F.element_at(F.array(*map(F.lit, WORST_FIRST)), F.min(rank) + 1).alias("status"))


def histogram(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, histogram): a map of counts of each value, counted before values meet in a group's map."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    entries = F.sort_array(F.collect_list(F.struct(F.coalesce(F.col(value).cast("string"), F.lit("none")).alias("k"), "n")))
    return counts.groupBy(*by).agg(F.map_from_entries(entries).alias("histogram"))


def metadata_rollup(df: DataFrame, by: list[str], order: list[str], at: str, settings: list[str], sums: list[str], reason: str) -> DataFrame:
    """A row a run: first non-null settings in ``order``, time bounds, sums, and a histogram of stop reasons."""
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in settings]
    out = df.groupBy(*by).agg(*first, F.min(at).alias("first_at"), F.max(at).alias("last_at"), *(F.sum(c).alias(c) for c in sums))
    return out.join(histogram(df, by, reason), by)


def merge_counters(frames: list[DataFrame], by: list[str], counters: list[str]) -> DataFrame:
    """Counter rows of several inputs summed by key; a counter that an input lacks counts as 0."""
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out.groupBy(*by).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters))


def page_coverage(pages: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Pages (ok, n_rows, n_kept, n_truncated, stop_reason) by source and keyword: attempts, outcomes, drops, last stop reason."""
    return pages.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"),
        F.sum(F.col("n_rows") - F.col("n_kept")).alias("deduped"), F.sum("n_truncated").alias("truncated"), F.max_by("stop_reason", F.struct(*order)).alias("stop_reason"),
    )


def dedup_pages(rows: DataFrame, scope: list[str], key: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(first row of each key in page order, dropped rows of each scope)."""
    rest = [c for c in rows.columns if c not in (*scope, key)]
    once = rows.groupBy(*scope, key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"), F.count(F.lit(1)).alias("n"))
    return once.select(*scope, key, *(F.col("r")[c].alias(c) for c in rest)), once.groupBy(*scope).agg(F.sum(F.col("n") - 1).alias("dropped"))


def truncated(df: DataFrame, order: list[Column], most: int) -> tuple[DataFrame, DataFrame]:
    """(the first ``most`` rows, a row with how many were cut off)."""
    return df.orderBy(*order).limit(most), df.agg(F.greatest(F.count(F.lit(1)) - most, F.lit(0)).alias("truncated"))


def missing_ids(left: DataFrame, right: DataFrame, key: str, most: int = 20) -> DataFrame:
    """(n, first): how many keys of ``left`` ``right`` lacks, and the smallest ``most`` of them."""
    gone = left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")
    first = gone.orderBy(key).limit(most).agg(F.sort_array(F.collect_list(key)).alias("first"))
    return gone.agg(F.count(F.lit(1)).alias("n")).join(first)  # one row each


def differences(left: DataFrame, right: DataFrame, key: str, left_only: str, right_only: str) -> DataFrame:
    """(key, side) of keys that only one of two tables has."""
    a, b = left.select(key).distinct().withColumn("_l", F.lit(1)), right.select(key).distinct().withColumn("_r", F.lit(1))
    both = a.join(b, key, "full").where("_l is null or _r is null")
    return both.select(key, F.when(F.col("_r").isNull(), left_only).otherwise(right_only).alias("side"))


def sample_targets(df: DataFrame, by: str, most: int) -> DataFrame:
    """Rows of each source, and how many of them to read back."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).withColumn("target", F.least("n", F.lit(most).cast("long")))


def stage_durations(runs: DataFrame, by: str, stage: str, stages: list[str]) -> DataFrame:
    """A row a run with each stage's duration in ms (runs: started_at, finished_at), null for a stage it lacks."""
    ms = F.floor((F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1000)
    return runs.groupBy(by).agg(*(F.max(F.when(F.col(stage) == s, ms)).alias(f"{s}_ms") for s in stages))


def handoff(ledger: DataFrame, sent: DataFrame, keys: list[str]) -> DataFrame:
    """Ledger rows to add: sent events by their unique keys that the ledger doesn't have yet. A null key equals a null key, so a second run adds nothing."""
    held, = unused(sent.select(*keys), "held")
    both = sent.select(*keys, F.lit(0).alias(held)).unionByName(ledger.select(*keys, F.lit(1).alias(held)))
    return both.groupBy(*keys).agg(F.max(held).alias(held)).where(F.col(held) == 0).select(*keys)
