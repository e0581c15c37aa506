"""Strict checks of runs, and projections of listings for readers and for notifications."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The stages of a run, and lines that are no heading although they are in capitals.
STAGES = ("scrape", "normalize", "enrich", "sync", "notify")
NO_HEADING = r"(?i)minimal|pengalaman|menguasai"


def strict_invariants(
    stages: DataFrame, raw: DataFrame, normalized: DataFrame, decisions: DataFrame, quarantine: DataFrame, logs: DataFrame, sent: DataFrame, handed: DataFrame
) -> DataFrame:
    """(run, name, passed, violations) of the nine rules that a finished run keeps, for every run of any input.

    stages (run, stage, status, error, skipped, reason), raw and normalized (run, id), decisions
    (run, id, eligible), quarantine (run, safe), logs (run, ok), sent and handed (run, ok). Every
    input is combined to a row a run before runs are joined, and each id is met once.
    """
    n = F.count(F.lit(1))
    at = lambda stage, status: (F.col("stage") == stage) & F.col("status").isin(*status)
    bad = ("failed", "partial")
    by_stage = stages.groupBy("run").agg(
        F.count_distinct(F.when(F.col("stage").isin(*STAGES), F.col("stage"))).alias("present"), F.sum(F.when(F.col("stage") == "normalize", F.col("skipped"))).alias("skipped"),
        F.count_if(at("enrich", bad)).alias("enrich_bad"), F.count_if(at("sync", ("completed",)) & F.col("reason").isNull()).alias("sync_silent"),
        F.count_if(at("notify", ("completed",)) & F.col("reason").isNull()).alias("notify_silent"), F.count_if(F.col("status").isin(*bad) & F.col("error").isNull()).alias("unexplained"),
    )
    # one row an id tells whether it was fetched, normalised and decided on
    marks = [raw.select("run", "id", F.lit(1).alias("r")), normalized.select("run", "id", F.lit(1).alias("m")), decisions.select("run", "id", F.when(F.col("eligible"), 1).otherwise(0).alias("e"))]
    ids = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marks).groupBy("run", "id").agg(F.count("r").alias("r"), F.count("m").alias("m"), F.max("e").alias("e"))
    by_id = ids.groupBy("run").agg(
        F.sum("r").alias("raw"), F.sum("m").alias("normalized"), F.count_if(F.expr("e = 0")).alias("declined"), F.count_if(F.expr("r > 0 and e is null")).alias("undecided"), F.count_if(F.expr("m > 0 and e = 0")).alias("against"),
    )
    held = quarantine.groupBy("run").agg(n.alias("held"), F.count_if(~F.col("safe")).alias("unsafe"))
    ok = lambda df, name, want: df.groupBy("run").agg(F.count_if(F.col("ok") == want).alias(name))
    parts = [by_stage, by_id, held, ok(logs, "failed_logs", False), ok(sent, "sent", True), ok(handed, "handed", True)]
    row = reduce(lambda a, b: a.join(b, "run", "full"), parts).na.fill(0)
    gap = F.col("raw") - F.col("normalized")
    explained = (F.col("held") > 0) | (F.col("skipped") > 0) | (F.col("declined") > 0)
    zero = lambda silent, count: F.when((F.col(silent) > 0) & (F.col(count) == 0), 1).otherwise(0)
    rules = {
        "stageRowsPresent": len(STAGES) - F.col("present"), "normalizeCountInvariant": F.when((gap == 0) | (gap > 0) & explained, 0).otherwise(1),
        "normalizeHasEligibilityDecision": F.col("undecided"), "normalizeRespectsEligibilityDecision": F.col("against"), "quarantineSafeErrorEvidence": F.col("unsafe"),
        "enrichFailureHasAiEvidence": F.when((F.col("enrich_bad") > 0) & (F.col("failed_logs") == 0), 1).otherwise(0), "syncZeroSentHasReason": zero("sync_silent", "sent"),
        "notifyZeroSentHasReason": zero("notify_silent", "handed"), "failedStageHasErrorEvidence": F.col("unexplained"),
    }
    long = row.select("run", *(c.cast("long").alias(name) for name, c in rules.items())).unpivot(["run"], list(rules), "name", "violations")
    return long.select("run", "name", (F.col("violations") == 0).alias("passed"), "violations")


def log_signals(logs: DataFrame, by: str, order: list[str], last: list[str]) -> DataFrame:
    """Requests, successes and failures of each listing's log (status), with its last row's ``last`` columns."""
    status = F.upper(F.trim("status"))
    out = logs.groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count_if(status == "SUCCEEDED").alias("succeeded"), F.count_if(status == "FAILED").alias("failed"), F.max_by(F.struct(*last), F.struct(*order)).alias("r"))
    return out.select(by, "total", "succeeded", "failed", *(F.col("r")[c].alias(f"last_{c}") for c in last))


def best_text(df: DataFrame, by: list[str], text: str, order: list[str], noisy: Column) -> DataFrame:
    """The longest text of each key, one without noise before any other, the first of equals in ``order``."""
    place = F.struct(noisy.cast("int").alias("n"), (-F.length(text)).alias("l"), *order)
    return df.where(F.length(text) > 0).groupBy(*by).agg(F.min_by(text, place).alias(text))


def distinct_ids(frames: list[DataFrame], key: str) -> DataFrame:
    """Distinct keys of several inputs."""
    return reduce(lambda a, b: a.unionByName(b), (f.select(key) for f in frames)).where(F.col(key).isNotNull()).distinct()


def combined(a: Column, b: Column) -> Column:
    """Two texts with a blank line between, or the longer one if it holds the other; blank ones are left out."""
    x, y = F.nullif(F.trim(a), F.lit("")), F.nullif(F.trim(b), F.lit(""))
    return F.when(x.isNull() | F.contains(y, x), y).when(y.isNull() | F.contains(x, y), x).otherwise(F.concat(x, F.lit("\n\n"), y))


def without_headings(c: Column, title: Column) -> Column:
    """Lines of a text without blank ones, those that only repeat the title, and headings (up to six words in capitals); null if none is left."""
    key = lambda x: F.lower(F.regexp_replace(x, r"[^\p{L}\p{N}]", ""))
    heading = lambda x: (F.upper(x) == x) & (F.size(F.split(x, r"\s+")) <= 6) & ~x.rlike(NO_HEADING)
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: (x != "") & (key(x) != key(F.coalesce(title, F.lit("")))) & ~heading(x))
    return F.nullif(F.array_join(lines, "\n"), F.lit(""))


def notification_candidates(sent: DataFrame, listings: DataFrame) -> DataFrame:
    """A row a sent event (id, run, source, external_id) of a known listing: its event id and what a notification shows."""
    shown = [c for c in listings.columns if c not in ("source", "external_id")]
    row = sent.join(listings, ["source", "external_id"])
    return row.select(F.concat_ws(":", "run", "source", "external_id").alias("event_id"), F.col("id").alias("sync_event_id"), "source", "external_id", *shown)
