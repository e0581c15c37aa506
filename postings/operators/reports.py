"""Reports in long form: metrics by scope, warnings, category counts, model usage, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.operators.ranks import unused


def metrics(df: DataFrame, scope: Column, values: dict[str, Column]) -> DataFrame:
    """(scope, metric, value) for each scope and for "all", from one pass."""
    part, every = unused(df, "part_of", "every")
    wide = df.withColumn(part, scope).rollup(part).agg(*(c.cast("double").alias(n) for n, c in values.items()), F.grouping(part).alias(every))
    named = wide.select(F.when(F.col(every) == 1, "all").otherwise(F.coalesce(part, F.lit("unknown"))).alias("scope"), *values)
    return named.unpivot(["scope"], list(values), "metric", "value")


def warnings(found: DataFrame, rules: list[tuple[str, str, str, float]]) -> DataFrame:
    """(scope, name, severity, value) of rules (name, metric, severity, limit) whose metric is above its limit."""
    fired = F.array_compact(F.array(*(F.when((F.col("metric") == m) & (F.col("value") > limit), F.struct(F.lit(n).alias("name"), F.lit(s).alias("severity"))) for n, m, s, limit in rules)))
    return found.select("scope", "value", F.explode(fired).alias("w")).select("scope", "w.name", "w.severity", "value")


def failure_summary(df: DataFrame, failed: Column, by: list[Column]) -> DataFrame:
    """Failures by category, most frequent first, then by category; nulls are a category and come last."""
    counts = df.where(failed).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *(F.asc_nulls_last(c) for c in counts.columns[:-1]))


def model_usage(logs: DataFrame, model: Column, status: Column) -> DataFrame:
    """Requests, successes, failures and rate limits of each model; both spellings of success count."""
    name = F.coalesce(F.nullif(F.trim(model), F.lit("")), F.lit("unknown"))
    ok, limited = status.isin("success", "succeeded"), status == "rate_limited"
    return logs.groupBy(name.alias("model")).agg(F.count(F.lit(1)).alias("requests"), F.count_if(ok).alias("successes"), F.count_if(~ok & ~limited).alias("failed"), F.count_if(limited).alias("rate_limited"))


def completeness(df: DataFrame, by: str, state: Column) -> DataFrame:
    """Complete, partial and unknown rows of each group and the partial rate."""
    n = lambda s: F.count_if(state == s)
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias("total"), n("complete").alias("complete"), n("partial").alias("partial"))
    return out.withColumns({"unknown": F.col("total") - F.col("complete") - F.col("partial"), "partial_rate": F.bround(F.col("partial") / F.col("total"), 4)})


def zero_sent_reason(attempted: Column, sent: Column, failed: Column) -> Column:
    """Why a run sent nothing; null if it sent something."""
    return F.when(sent > 0, None).when(attempted == 0, "no_eligible_jobs").when(failed == attempted, "all_failed").when(failed > 0, "some_failed").otherwise("nothing_pending")
