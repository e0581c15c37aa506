"""Data-quality metrics, coverage, invariants and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_blank_profile(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows, nulls and blanks of each column in one pass, for all rows or for each group."""
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        metrics.append(F.count_if(F.col(c).isNull()).alias(f"{c}_null"))
        metrics.append(F.count_if(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "").alias(f"{c}_blank"))
    return df.groupBy(*(by or [])).agg(*metrics)


def coverage(parents: DataFrame, children: DataFrame, key: str, child_key: str, by: str) -> DataFrame:
    """Parents with and without a child, and the share with one, for each group."""
    has = children.select(F.col(child_key).alias(key)).where(F.col(key).isNotNull()).distinct().withColumn("_has", F.lit(1))
    out = parents.join(has, key, "left").groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count("_has").alias("with_child"))
    return out.withColumns({"without_child": F.col("total") - F.col("with_child"), "rate": F.bround(F.col("with_child") / F.col("total"), 4)})


def orphans(children: DataFrame, parents: DataFrame, child_key: str, key: str) -> DataFrame:
    """Children whose parent doesn't exist."""
    return children.join(parents.select(F.col(key).alias(child_key)).distinct(), child_key, "left_anti")


def invariant(df: DataFrame, name: str, bad: Column) -> DataFrame:
    """(name, passed, violations) of a rule that no row may break."""
    return df.agg(F.count_if(bad).alias("violations")).select(F.lit(name).alias("name"), (F.col("violations") == 0).alias("passed"), "violations")


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def gates(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """(metric, value, lower, upper, passed): metrics (metric, value) held against limits (metric, lower, upper); a missing metric fails."""
    row = limits.join(metrics, "metric", "left")
    inside = F.coalesce((F.col("value") >= F.coalesce("lower", F.lit(float("-inf")))) & (F.col("value") <= F.coalesce("upper", F.lit(float("inf")))), F.lit(False))
    return row.select("metric", "value", "lower", "upper", inside.alias("passed"))
