"""Nested JSON as rows: every text with its path, evidence by families of keys, ids at any depth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import html, skills, text
from postings.operators.ranks import unused
from postings.operators.shared import materialize

# fixed values: families of keys under which evidence stands, and words of benefits
FAMILIES = {
    "description": ("description", "responsibilities", "job_description", "about", "content"),
    "requirement": ("requirements", "qualification", "qualifications", "requirement_summary"),
    "skill": ("skills", "skill", "technologies", "technology", "tech_stack", "tags"),
}
BENEFITS = r"(?i)\b(thr|tunjangan|benefit|benefits?|fasilitas|bonus|cuti|bpjs|gaji pokok|kompensasi)\b"
SHORTEST, SKILL_CHARS, SKILLS_MOST = 2, 80, 20
TRACKING = r"(?i)(trace|tracking|queryid|query_id|solid|sol_id)"


#: Levels that are opened in one pass before anything is written.
LEVELS = 6


def scalars(df: DataFrame, keys: list[str], json: str, families: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A row a scalar at any depth of a JSON column: (keys, place, names, value, kind).

    ``names`` are the object keys on the way, outermost first, ``place`` the positions (of keys in
    alphabetical order, of list entries), ``kind`` Spark's type of the value. Null and invalid JSON have
    no row. Containers are opened LEVELS levels a pass, all rows at once, inside the JVM; each pass
    is written once, and as many follow as the deepest value needs. With ``families``, a column ``below``
    has a bit for each whose names (case aside) hold a key on the way.
    """
    value, place, names = "value", "place", "names"
    families = families or {}
    spark = df.sparkSession
    level = df.select(
        *keys, F.array().cast("array<int>").alias(place), F.array().cast("array<string>").alias(names), F.lit(0).alias("below"), F.try_parse_json(json).alias(value)
    ).where(f"{value} is not null")
    bits = F.lit(0)
    for i, members in enumerate(families.values()):
        bits = bits.bitwiseOR(F.when(F.lower("key").isin(*members), 1 << i).otherwise(0))
    container = lambda kind: kind.startswith("OBJECT") | kind.startswith("ARRAY")
    columns = [*keys, place, names, *(["below"] if families else [])]
    found = []
    while True:
        for _ in range(LEVELS):  # a scalar goes through as it is, an empty container has no row
            inner = level.withColumnRenamed(value, "whole").lateralJoin(spark.tvf.variant_explode_outer(F.col("whole").outer()))
            inner = inner.where(F.when(F.col("pos").isNull(), ~container(F.schema_of_variant("whole"))).otherwise(True))
            level = inner.select(
                *keys, F.when(F.col("pos").isNull(), F.col(place)).otherwise(F.array_append(place, F.col("pos"))).alias(place),
                F.when(F.col("key").isNull(), F.col(names)).otherwise(F.array_append(names, F.col("key"))).alias(names),
                (F.when(F.col("key").isNull(), F.col("below")).otherwise(F.col("below").bitwiseOR(bits)) if families else F.col("below")).alias("below"),
                F.when(F.col("pos").isNull(), F.col("whole")).otherwise(F.col(value)).alias(value),
            )
        opened = materialize(level.withColumn("kind", F.schema_of_variant(value)), "json-levels")
        found.append(opened.where(~container(F.col("kind"))).select(*columns, F.try_variant_get(value, "$", "string").alias(value), "kind"))
        level = opened.where(container(F.col("kind"))).drop("kind")
        if level.isEmpty():
            break
    return reduce(lambda a, b: a.unionByName(b), found)


def block_text(c: Column) -> Column:
    """A text with tags as plain text, without signs that only decorate, spaces put together; null if nothing is left."""
    bare = F.translate(text.without_noise(c), "•▪◦", "   ")
    return text.clean(F.when(c.rlike("<[^>]+>"), html.to_text(bare)).otherwise(bare))


def evidence(df: DataFrame, keys: list[str], json: str, families: dict[str, tuple[str, ...]] = FAMILIES) -> DataFrame:
    """(keys, family, place, text): texts at any depth below a key of a family (case aside), as plain text of two characters or more.

    A text below keys of several families is in each of them; a skill has at most 80 characters.
    """
    rows = scalars(df, keys, json, families).where("kind = 'STRING' and below <> 0").withColumn("text", block_text(F.col("value"))).where(F.length("text") >= SHORTEST)
    member = [F.when((F.col("below").bitwiseAND(1 << i) != 0) & ((F.length("text") <= SKILL_CHARS) if f == "skill" else F.lit(True)), f) for i, f in enumerate(families)]
    return rows.select(*keys, F.explode(F.array(*member)).alias("family"), "place", "text").where("family is not null")


def best_evidence(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, description, requirement, skills) of evidence rows: the longest description, the longest requirement
    (one without benefits if there is any), at most 20 different skills in order; without any, technical terms of both texts.
    Of equally long texts the first in place counts.
    """
    longest = F.struct(-F.length("text"), "place")
    of = lambda f: F.col("family") == f
    rows = found.groupBy(*keys).agg(
        F.min_by(F.when(of("description"), F.col("text")), F.when(of("description"), longest)).alias("description"),
        F.min_by(F.when(of("requirement"), F.col("text")), F.when(of("requirement"), F.struct(F.col("text").rlike(BENEFITS), longest))).alias("requirement"),
        F.array_sort(F.collect_list(F.when(of("skill"), F.struct("place", "text")))).alias("given"),
    )
    once = text.first_by(F.transform("given", lambda x: x["text"]), F.lower)
    terms = text.first_by(F.flatten(F.array(*(F.coalesce(skills.canonical_terms(F.col(c)), F.array().cast("array<string>")) for c in ("requirement", "description")))), F.lower)
    return rows.select(*keys, "description", "requirement", F.slice(F.when(F.size("given") > 0, once).otherwise(terms), 1, SKILLS_MOST).alias("skills"))


def ids_inside(df: DataFrame, keys: list[str], json: str, names: tuple[str, ...]) -> DataFrame:
    """(keys, found_id, depth): the id of each JSON value: the outermost text or whole number under one of ``names``.

    Of one depth the first name counts, then the first place. Nothing below a tracking key is looked at.
    """
    rows = scalars(df, keys, json).where("kind in ('STRING', 'BIGINT') and size(names) > 0")
    last = F.element_at("names", -1)
    above = F.slice("names", 1, F.size("names") - 1)
    rows = rows.where(last.isin(*names) & ~F.exists(above, lambda n: n.rlike(TRACKING)) & (F.trim("value") != ""))
    rank = F.array_position(F.array(*map(F.lit, names)), last)
    return rows.groupBy(*keys).agg(F.min(F.struct(F.size("place").alias("depth"), rank, "place", "value")).alias("first")).select(*keys, F.trim(F.col("first.value")).alias("found_id"), F.col("first.depth").alias("depth"))


def attributed(logs: DataFrame, keys: list[str], json: str, names: tuple[str, ...], jobs: DataFrame, job_id: str) -> DataFrame:
    """``logs`` with the job that an id inside their JSON names (null: no id, or no such job).

    Ids are joined as texts with the distinct ids of jobs, so a job with very many logs is a hot key of one side only,
    which adaptive execution splits.
    """
    key, named = unused(jobs, "job_key", "named_job")
    known = jobs.select(F.col(job_id).cast("string").alias(key), F.col(job_id).alias(named)).where(F.col(key).isNotNull()).distinct()
    found = ids_inside(logs, keys, json, names).join(known, F.col("found_id") == F.col(key))
    return logs.join(found.select(*keys, F.col(named).alias(job_id)), keys, "left")
