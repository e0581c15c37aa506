"""Tables in the folder that all executors share: they cut lineage and outlive executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one of a local session.

    A session on a cluster must name the folder; a machine-local one would lose rows there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if found:
        # a path without a scheme means Spark's default file system, for Python writers too
        path = context._jvm.org.apache.hadoop.fs.Path(found)
        full = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
        return full.replace("file:/", "file:///", 1).rstrip("/") if re.match("file:/[^/]", full) else full.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_dir:
        _own_dir[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='spark-postings-')}"
    return _own_dir[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    It cuts lineage like a checkpoint, but stays columnar, compressed and prunable, and it
    survives the loss of executors. The folder is named by the application id, so that whoever
    owns spark.checkpoint.dir can remove a finished application's tables together.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
