"""A latest-write-wins table that grows by streams: only the parts whose keys a batch holds are written anew.

A table is a folder: ``data/v=<batch>/part=<part>`` holds what a batch wrote, ``versions/<batch>``
says which version of every part is current. That file is published last, by a rename, so a reader
sees all of a batch or nothing, and a batch that runs again changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postings.operators import keyed
from postings.operators.ranks import unused

#: Parts of a table (a power of 2; a part is what a batch rewrites for one key), and published versions that stay readable.
PARTS, KEPT = 64, 2


class Folder:
    """A folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._system = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return [s.getPath().getName() for s in self._system.listStatus(at)] if self._system.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a hidden file, then give it its name: readers find it whole or not at all."""
        hidden = self._at(f"{name.rpartition('/')[0]}/.{name.rpartition('/')[2]}")
        stream = self._system.create(hidden, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._system.rename(hidden, self._at(name)):
            raise OSError(f"cannot publish {name}")

    def drop(self, name: str) -> None:
        self._system.delete(self._at(name), True)


def versions(folder: Folder) -> list[int]:
    """Published batches, ascending."""
    return sorted(int(n) for n in folder.names("versions") if n.isdigit())


def _manifest(folder: Folder, version: int) -> dict:
    found = json.loads(folder.read(f"versions/{version}"))
    return found | {"parts": {int(p): v for p, v in found["parts"].items()}}


def _paths(folder: Folder, parts: dict[int, int], only: set[int] | None = None) -> list[str]:
    return [f"{folder.path}/data/v={v}/part={p}" for p, v in sorted(parts.items()) if only is None or p in only]


def merge(table_path: str, batch: DataFrame, number: int, keys: list[str], order: list[str], parts: int = PARTS) -> dict:
    """Fold one batch into the table, and give the manifest that is current then: n_parts, schema, and each part's version.

    Parts go by the keys' hash (null keys are keys); of equal keys the row last by ``order`` stays, stored
    or new, so a late duplicate loses. Nothing happens if this batch, or a later one, is already published.
    Files of versions older than the last KEPT go once the new one is out.
    """
    folder = Folder(batch.sparkSession, table_path)
    done = versions(folder)
    last = _manifest(folder, done[-1]) if done else {"n_parts": parts, "parts": {}}
    if done and number <= done[-1]:
        return last
    n = last["n_parts"]
    part, = unused(batch, "part")
    placed = batch.withColumn(part, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
    touched = {r[0] for r in placed.select(part).distinct().collect()}  # n numbers at most
    if touched:
        old = _paths(folder, last["parts"], touched)
        both = placed.drop(part)
        if old:
            both = batch.sparkSession.read.schema(batch.schema).parquet(*old).unionByName(both)
        merged = keyed.latest_by(both, keys, order).withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
        merged.repartition(min(n, len(touched)), "part").write.mode("overwrite").partitionBy("part").parquet(f"{folder.path}/data/v={number}")
    now = {"n_parts": n, "parts": last["parts"] | dict.fromkeys(touched, number), "schema": batch.schema.json()}
    folder.publish(f"versions/{number}", json.dumps(now))
    clean(folder)
    return now


def clean(folder: Folder) -> None:
    """Drop what no kept version holds: old markers first, then their files; leftovers of batches that never were published, too."""
    done = versions(folder)
    for v in done[:-KEPT]:
        folder.drop(f"versions/{v}")
    used = {(v, p) for m in done[-KEPT:] for p, v in _manifest(folder, m)["parts"].items()}
    for name in folder.names("data"):
        v = int(name.split("=")[1])
        if v > done[-1]:
            continue
        for part in folder.names(f"data/{name}"):
            if part.startswith("part=") and (v, int(part.split("=")[1])) not in used:
                folder.drop(f"data/{name}/{part}")
        if not any(x == v for x, _ in used):
            folder.drop(f"data/{name}")


def current(spark: SparkSession, table_path: str, version: int | None = None) -> DataFrame:
    """The table as last published, or as of one of the kept versions."""
    folder = Folder(spark, table_path)
    done = versions(folder)
    if not done:
        raise FileNotFoundError(f"no version of {table_path} is published")
    found = _manifest(folder, done[-1] if version is None else version)
    schema = spark.createDataFrame([], "part int").schema.fromJson(json.loads(found["schema"]))
    paths = _paths(folder, found["parts"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_stream(stream: DataFrame, table_path: str, checkpoint: str, keys: list[str], order: list[str], parts: int = PARTS) -> StreamingQuery:
    """Fold every batch of a stream into the table; a restart goes on behind the last published batch."""

    def fold(batch: DataFrame, number: int) -> None:
        merge(table_path, batch, number, keys, order, parts)

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
