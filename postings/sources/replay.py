"""Replay of captured payloads as synthetic rows, as a table or as a stream with offsets and a bound on each batch."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from postings.operators.ranks import numbered, unused

FORMAT = "payload_replay"


class ReplayReader(SimpleDataSourceStreamReader):
    """Numbers 0 to ``total`` - 1, at most ``rows`` a batch; the offset is the next number, so a restart goes on there."""

    def __init__(self, total: int, rows: int):
        self.total, self.rows = total, rows

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = {"at": min(self.total, start["at"] + self.rows)}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(i,) for i in range(start["at"], end["at"])])


class Replay(DataSource):
    """Options: ``total``, ``rowsPerBatch``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "number long"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return ReplayReader(int(self.options["total"]), int(self.options.get("rowsPerBatch", 1000)))


def _rows(df: DataFrame, source: str, payload: str, now: Column) -> DataFrame:
    external = F.concat(F.col(source).cast("string"), F.lit("-fixture-"), F.col("copy"))
    url = F.concat(F.lit("https://example.test/"), F.col(source).cast("string"), F.lit("/fixture-"), F.col("copy"))
    return df.select(F.col(source), external.alias("external_id"), url.alias("source_url"), F.col(payload), (now - F.make_interval(mins=F.col("copy"))).alias("source_timestamp"))


def replayed(payloads: DataFrame, source: str, payload: str, copies: int, now: Column) -> DataFrame:
    """``copies`` rows of each payload: (source, external_id, source_url, payload, source_timestamp), a minute apart, the first the latest."""
    return _rows(payloads.select(source, payload).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))), source, payload, now)


def replay_stream(payloads: DataFrame, source: str, payload: str, copies: int, now: Column, rows_per_batch: int = 1000) -> DataFrame:
    """The rows of ``replayed`` as a stream of at most ``rows_per_batch`` rows a batch, payloads in order of (source, payload).

    The driver hands out numbers only; payloads are joined to them by their place. ``payloads`` is a table that doesn't change, of a known size.
    """
    spark: SparkSession = payloads.sparkSession
    spark.dataSource.register(Replay)
    place, = unused(payloads.select(source, payload), "place")
    known = numbered(payloads.select(source, payload), [], [source, payload], place)
    total = known.count() * copies
    numbers = spark.readStream.format(FORMAT).option("total", total).option("rowsPerBatch", rows_per_batch).load()
    refs = numbers.select((F.floor(F.col("number") / copies) + 1).alias(place), (F.col("number") % copies + 1).cast("int").alias("copy"))
    return _rows(refs.join(known, place), source, payload, now)
