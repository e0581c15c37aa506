"""Delivery: payload rows, batches with a hash, outcomes of responses, retry run ids, list with detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.operators import keyed

#: The consumer's limits and its name for each status.
BATCH_MOST, TITLE_MOST = 100, 255
STATUS_CODES = {"active": "ACTIVE", "stale": "STALE", "expired": "EXPIRED", "inactive": "CLOSED"}


def code(c: Column) -> Column:
    """Upper-case enum text."""
    return F.upper(F.translate(F.trim(c), "- ", "__"))


def status_code(c: Column) -> Column:
    out = F.when(c.isNull(), "HIDDEN")
    for name, to in STATUS_CODES.items():
        out = out.when(c == name, to)
    return out.otherwise("HIDDEN")


def payloads(jobs: DataFrame, fields: dict[str, Column], key: str) -> DataFrame:
    """(key, payload, payload_hash): a JSON payload of fields in name order with nulls left out, and its hash."""
    text = F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))))
    return jobs.select(key, text.alias("payload")).withColumn("payload_hash", F.sha2("payload", 256))


def batches(rows: DataFrame, scope: list[str], order: list[str], size: int) -> DataFrame:
    """(scope, chunk, n, body, chunk_hash): arrays of at most ``size`` payloads, in order; a chunk's rows are bounded by size."""
    if not 1 <= size <= BATCH_MOST:
        raise ValueError(f"a batch holds 1 to {BATCH_MOST} payloads")
    cut = keyed.chunks(rows, scope, order, size)
    grouped = cut.groupBy(*scope, "chunk").agg(F.sort_array(F.collect_list(F.struct(*order, "payload"))).alias("r"))
    body = F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x["payload"]), ","), F.lit("]"))
    return grouped.select(*scope, "chunk", F.size("r").cast("long").alias("n"), body.alias("body")).withColumn("chunk_hash", F.sha2("body", 256))


def outcome(status: Column) -> Column:
    """What a response status (null: no response) means for every row of its batch."""
    return (
        F.when(status.isNull(), "retryable").when(status.between(200, 299), "sent").when(status == 404, "retryable").when(status.between(400, 499), "final").otherwise("retryable")
    )


def halved_sizes(attempts: DataFrame, scope: list[str], order: list[str], start: int, least: int = 1) -> DataFrame:
    """The chunk size after each run's attempts: halved after every retryable failure, never below ``least``."""
    # halvings commute with attempts of other outcomes, so their number is enough
    folded = attempts.groupBy(*scope).agg(F.count_if(outcome(F.col("status")) == "retryable").alias("n"))
    size = F.when(F.col("n") == 0, start).otherwise(F.greatest(F.floor(F.lit(start) / F.pow(F.lit(2.0), F.least("n", F.lit(60)))), F.lit(least)))
    return folded.select(*scope, size.cast("int").alias("chunk_size"))


def base_run_id(c: Column) -> Column:
    """A run id without its stage and retry suffixes."""
    return F.regexp_replace(c, "(-(scrape|normalize|enrich|sync|notify))?(-retry-[0-9]+)?$", "")


def next_retry_id(runs: DataFrame, run: str) -> DataFrame:
    """The next retry id of each base run."""
    base = runs.select(base_run_id(F.col(run)).alias("base"), F.col(run).rlike("-retry-[0-9]+$").alias("retry"))
    n = base.groupBy("base").agg(F.count_if("retry").alias("n"))
    return n.select("base", F.concat("base", F.lit("-retry-"), F.lpad((F.col("n") + 1).cast("string"), 2, "0")).alias("next_run"))


def with_detail(listed: DataFrame, detail: DataFrame, key: str, status: str) -> DataFrame:
    """``listed`` with ``detail``'s payload, completeness and why it is missing (from its fetch status)."""
    one = detail.groupBy(key).agg(F.max_by(F.struct("payload", status), F.coalesce(status, F.lit(0))).alias("d"))
    row = listed.join(one, key, "left")
    s, body = F.col("d")[status], F.col("d")["payload"]
    reason = F.when(body.isNotNull(), None).when(F.col("d").isNull(), "not_attempted").when(s == 404, "not_found").when(s == 429, "rate_limited").when(s >= 500, "source_error").otherwise("fetch_failed")
    return row.select(
        *listed.columns, body.alias("detail_payload"), F.when(body.isNotNull(), "complete").otherwise("partial").alias("completeness"), reason.alias("missing_reason"),
        F.when(body.isNull(), (s == 429) | (s >= 500)).alias("retryable"),
    )
