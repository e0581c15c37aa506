"""Training corpus from raw documents: quality, near copies, benchmark leaks, mixture, token files.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``. ``run`` writes each result as Parquet and reads it
back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.llm.common import materialize
from postings.llm.decontaminate import contamination
from postings.llm.mixing import mix
from postings.llm.near_dedup import near_duplicates
from postings.llm.quality_classifier import fit, quality_scores
from postings.llm.token_files import token_files


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows of these ids; rows of null ids stay.

    The ids are written first: their size is then known, and Spark broadcasts them only under
    its threshold; beyond it, both sides are shuffled.
    """
    gone = materialize(ids.select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on labelled ones outside the held-out third."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    return quality_scores(docs, model, keep=docs.columns).where("predicted = 1").select(*(f"keep_{c}" for c in docs.columns)).toDF(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies: five-word shingles, similarity 0.8."""
    return without(docs, near_duplicates(docs, k=5, percent=80).where("not kept"))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item, re-parameterised ones included."""
    return without(docs, contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks, in a global random order."""
    return mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending doc_id order (copies side by side), and their index."""
    return token_files(spark, docs)


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_each),
    ("benchmark", no_benchmark),
    ("mixture", mixture),
    ("tokens", tokens),
]
#: A trained model, hashed candidates and a tokenizer: SQL can't express it; tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
