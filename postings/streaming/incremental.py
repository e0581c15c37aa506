"""Files as a stream, repeated observations and daily counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, path: str, schema: str, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def first_observations(stream: DataFrame, keys: list[str], at: str, delay: str = "3 days") -> DataFrame:
    """Each key once within the delay; state older than the watermark goes."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def daily_counts(stream: DataFrame, at: str, by: str, delay: str = "1 day") -> DataFrame:
    """Rows a day and group, final once the watermark has passed the day."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, "1 day").alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), by, "n")
