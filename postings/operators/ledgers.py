"""Ledgers folded from append-only tables: eligibility, freshness, delivery, handoff, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions.identity import identity_hash, identity_key

MAX_ATTEMPTS = 3


def eligibility(raw: DataFrame, consumer: DataFrame, staged: DataFrame, states: DataFrame, *, order: list[str], reprocess: bool = False, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Decision of every raw row (raw_id, source, external_id, payload_hash, ...): why it is, or isn't, to be normalised.

    ``consumer`` has (source, external_id) it already knows, ``staged`` (job_id, source,
    external_id, raw_hash) and ``states`` (job_id, state, attempts). In this order: missing
    identity, duplicate in scope, known to the consumer, new, then by delivery state. Keys are
    folded on both sides.
    """
    keyed = raw.withColumn("identity_key", identity_key(F.col("source"), F.col("external_id")))
    firsts = keyed.where("identity_key is not null").groupBy("identity_key").agg(F.min(F.struct(*order)).alias("first"))
    known = consumer.select(identity_key(F.col("source"), F.col("external_id")).alias("identity_key")).where("identity_key is not null").distinct().withColumn("in_consumer", F.lit(True))
    jobs = staged.select(identity_key(F.col("source"), F.col("external_id")).alias("identity_key"), "job_id", "raw_hash")
    jobs = jobs.where("identity_key is not null").groupBy("identity_key").agg(F.min_by(F.struct("job_id", "raw_hash"), "job_id").alias("j")).select("identity_key", "j.*")
    lookup = firsts.join(known, "identity_key", "left").join(jobs, "identity_key", "left").join(states, "job_id", "left")
    row = keyed.join(lookup, "identity_key", "left")
    changed = F.lit(reprocess) & F.coalesce(F.col("payload_hash") != F.col("raw_hash"), F.lit(False))
    decision = (
        F.when(F.col("identity_key").isNull(), "missing_identity")
        .when(F.struct(*order) != F.col("first"), "duplicate_in_scrape_scope")
        .when(F.col("in_consumer"), "existing_backend")
        .when(F.col("job_id").isNull(), "normalization_eligible")
        .when(F.col("state").isNull() | (F.col("state") == "sent"), F.when(changed, "reprocess_required").otherwise("existing_normalized_synced"))
        .when(F.col("state") == "failed", F.when(F.col("attempts") < max_attempts, "existing_normalized_unsynced").otherwise("identity_conflict"))
        .when(F.col("state").isin("pending", "dead-letter"), "existing_normalized_unsynced")
        .otherwise("identity_conflict")
    )
    return row.select(*raw.columns, "identity_key", identity_hash(F.col("identity_key")).alias("identity_hash"), "job_id", decision.alias("decision"))


def freshness(jobs: DataFrame, seen: DataFrame, keys: list[str], now: Column, *, stale_hours: int = 72, expired_hours: int = 336, run_ok: Column | None = None) -> DataFrame:
    """``jobs`` (keys, status, last_seen_at) after a sweep, with ``transition``.

    Seen ones become active and last seen now; unseen ones go stale or expire by age if the run
    succeeded, else stay. Sweeping twice changes nothing more.
    """
    if not 1 <= stale_hours < expired_hours:
        raise ValueError("stale_hours must be positive and below expired_hours")
    ok = F.lit(True) if run_ok is None else run_ok
    row = jobs.join(seen.select(*keys).distinct().withColumn("_seen", F.lit(True)), keys, "left")
    hours = (F.unix_micros(now) - F.unix_micros("last_seen_at")) / 3_600_000_000
    status = F.when(F.col("_seen"), "active").when(~ok, F.col("status")).when(hours >= expired_hours, "expired").when(hours >= stale_hours, "stale").otherwise(F.col("status"))
    same = status.eqNullSafe(F.col("status"))
    transition = F.when(same, "unchanged").when(F.col("_seen"), "reactivated").otherwise(status)
    last = F.when(F.col("_seen"), now).otherwise(F.col("last_seen_at"))
    return row.withColumns({"new_status": status, "transition": transition, "last_seen_at": last}).drop("_seen", "status").withColumnRenamed("new_status", "status")


def freshness_summary(swept: DataFrame, source: str) -> DataFrame:
    n = lambda c: F.count_if(c)
    return swept.groupBy(source).agg(
        n(F.col("status") == "active").alias("active"), n(F.col("transition") == "stale").alias("stale"), n(F.col("transition") == "expired").alias("expired"),
        n(F.col("transition") == "reactivated").alias("reactivated"), n(F.col("transition") == "unchanged").alias("unchanged"), F.count(F.lit(1)).alias("total"),
    )


def delivery_state(attempts: DataFrame, keys: list[str], *, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """State of each delivery from its attempts (keys, at, attempt_id, ok, error): sent, failed, dead-letter or pending.

    ``ok`` is null while an attempt is open. A success clears the error; attempts count open ones too.
    """
    order = F.struct("at", "attempt_id")
    folded = attempts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(~F.col("ok")).alias("failures"), F.coalesce(F.bool_or("ok"), F.lit(False)).alias("sent"),
        F.max_by("error", F.when(~F.col("ok"), order)).alias("last_error"), F.max("at").alias("last_at"),
    )
    state = F.when(F.col("sent"), "sent").when(F.col("failures") == 0, "pending").when(F.col("attempts") >= max_attempts, "dead-letter").otherwise("failed")
    return folded.select(*keys, "attempts", state.alias("state"), F.when(~F.col("sent"), F.col("last_error")).alias("error"), "last_at")


def is_retryable(state: Column, attempts: Column, max_attempts: int = MAX_ATTEMPTS) -> Column:
    return (state == "pending") | ((state == "failed") & (attempts < max_attempts))


def candidates(jobs: DataFrame, states: DataFrame, keys: list[str], order: list[Column], limit: int, *, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Jobs to deliver next: never tried, or retryable; the first ``limit`` by order."""
    row = jobs.join(states.select(*keys, "state", "attempts"), keys, "left")
    return row.where(F.col("state").isNull() | is_retryable(F.col("state"), F.col("attempts"), max_attempts)).orderBy(*order).limit(limit)


def run_rows(events: DataFrame, run: list[str], failed: Column, order: list[str], message: str) -> DataFrame:
    """A row a run: counts, first error, duration and status (failed if all failed, partial if some)."""
    out = events.groupBy(*run).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(failed).alias("n_failed"), F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
        F.min_by(F.when(failed, F.col(message)), F.when(failed, F.struct(*order))).alias("first_error"),
    )
    status = F.when(F.col("n_failed") == 0, "completed").when(F.col("n_failed") == F.col("n_rows"), "failed").otherwise("partial")
    return out.withColumns({"status": status, "duration_ms": F.floor((F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1000)})
