"""Listing features, task readiness and model rows over the star tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.functions import identity, salary

#: Weights of (completeness, requirements, skills, description) in each task's readiness.
TASKS = {
    "job_search_ranking": (0.4, 0.0, 0.3, 0.3),
    "job_fit_scoring": (0.3, 0.4, 0.3, 0.0),
    "skill_gap_analysis": (0.2, 0.5, 0.3, 0.0),
    "career_strategy_recommendation": (0.5, 0.25, 0.25, 0.0),
    "cv_analyzer_job_context": (0.35, 0.35, 0.0, 0.30),
    "application_intelligence": (0.65, 0.0, 0.35, 0.0),
    "eda_trend_analysis": (1.0, 0.0, 0.0, 0.0),
    "xai_explanation": (0.2, 0.4, 0.4, 0.0),
}
READY = 0.55


def filled_share(*columns: Column) -> Column:
    """Percent of the columns with a text, rounded half to even."""
    n = F.lit(0)
    for c in columns:
        n = n + (F.trim(F.coalesce(c.cast("string"), F.lit(""))) != "").cast("int")
    return F.bround(n / len(columns) * 100).cast("int")


def readiness(base: Column, has_requirements: Column, has_skills: Column, has_description: Column) -> dict[str, Column]:
    """Each task's weighted score in [0, 1], four digits."""
    parts = (base, *(c.cast("double") for c in (has_requirements, has_skills, has_description)))
    out = {}
    for task, weights in TASKS.items():
        total = F.lit(0.0)
        for w, p in zip(weights, parts, strict=True):
            if w:
                total = total + F.lit(w) * p
        out[task] = F.bround(total, 4)
    return out


def blockers(scores: dict[str, Column]) -> Column:
    """Names of tasks below the bar, in order."""
    return F.array_compact(F.array(*(F.when(c < READY, F.lit(t)) for t, c in scores.items())))


def fit_quality(has_requirements: Column, has_skills: Column, has_level: Column) -> Column:
    return (has_requirements.cast("int") * 50 + has_skills.cast("int") * 40 + has_level.cast("int") * 10).cast("int")


def recommendation_tier(stale: Column, quality: Column) -> Column:
    return F.when(~stale & (quality >= 80), "tier_1").when(~stale & (quality >= 60), "tier_2").otherwise("tier_3")


def align(df: DataFrame, header: list[str]) -> DataFrame:
    """Exactly the header's columns in its order, missing ones and nulls as empty texts."""
    have = set(df.columns)
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in header))


def dictionary(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """(file, column, type, place) of every export, from schemas alone."""
    rows = [(f, c, t, i) for f, df in frames.items() for i, (c, t) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "file string, column string, type string, place int")


def listing_base(orders: DataFrame, customer: DataFrame, lineitem: DataFrame, events: DataFrame) -> DataFrame:
    """A row a listing with its company, children aggregated once, and signals of its customer.

    Children and signals are aggregated before the joins, so that each join has one row a key.
    """
    kids = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_requirements"), F.count_distinct("l_partkey").alias("n_skills"), F.count_if(F.col("l_returnflag") == "R").alias("n_high")
    )
    signals = events.groupBy(F.col("user_id").alias("o_custkey")).agg(F.count_if(F.col("event_type") == "purchase").alias("n_accepted"), F.count_if(F.col("event_type") == "error").alias("n_rejected"))
    company = customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    out = orders.join(company, "o_custkey").join(kids, "o_orderkey", "left").join(signals, "o_custkey", "left")
    return out.na.fill(0, ["n_requirements", "n_skills", "n_high", "n_accepted", "n_rejected"])


def listing_features(base: DataFrame) -> DataFrame:
    """Derived columns of a listing: completeness, readiness, tiers, salary, split, fingerprint."""
    share = filled_share(F.col("c_name"), F.col("c_mktsegment"), F.col("o_orderpriority"), F.col("o_orderstatus"), F.nullif(F.col("n_requirements"), F.lit(0)))
    row = base.select(
        "o_orderkey", "n_requirements", "n_skills", "n_accepted", "n_rejected", "o_orderstatus", "c_name", "o_orderpriority", share.alias("completeness"),
        (F.col("n_requirements") > 0).alias("has_req"), (F.col("n_skills") > 0).alias("has_skill"), (F.col("o_orderstatus") == "F").alias("stale"),
        F.bround("o_totalprice").cast("long").alias("lo"), F.bround(F.col("o_totalprice") * 3).cast("long").alias("hi"),
    )
    quality = fit_quality(F.col("has_req"), F.col("has_skill"), F.col("o_orderpriority").startswith("1"))
    ratio = F.when(F.col("n_skills") > 0, F.bround(F.col("n_requirements") / F.col("n_skills"), 3))
    state = F.when(F.col("n_accepted") > 0, "accepted").when(F.col("n_rejected") > 0, "rejected").otherwise("none")
    key = F.concat_ws("|", F.lower("o_orderpriority"), F.lower(F.trim("c_name")), F.lower("o_orderstatus"))
    return row.select(
        "o_orderkey", "n_requirements", "n_skills", "completeness", quality.alias("fit_quality"), ratio.alias("ratio"), state.alias("tracker_state"),
        recommendation_tier(F.col("stale"), quality).alias("tier"), salary.bucket(F.col("lo"), F.col("hi")).alias("salary_bucket"), identity.split_of(key).alias("split"),
    )


def requirement_rows(lineitem: DataFrame, part: DataFrame, orders: DataFrame) -> DataFrame:
    """A row a child of a listing, with its dictionary entry and its place in the listing."""
    entry = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("value"), F.col("p_brand").alias("category"))
    parent = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("listing_status"))
    return requirement_columns(lineitem.join(entry, "l_partkey").join(parent, "l_orderkey"))


def requirement_columns(children: DataFrame) -> DataFrame:
    """The columns of requirement rows over children that have their entry's value and category and their listing's status."""
    kind = F.when(F.col("l_returnflag") == "R", "SKILL").when(F.col("l_returnflag") == "A", "EXPERIENCE").otherwise("OTHER")
    return children.select(
        "l_orderkey", F.col("l_linenumber").alias("sort_order"), "l_partkey", "l_suppkey", kind.alias("type"), "value", "category", F.bround("l_discount", 4).alias("confidence"), "listing_status"
    )


def signal_rows(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Counts of a customer's signals, none of their own keys or times of day; zero where there are none."""
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    signals = events.groupBy(F.col("user_id").alias("o_custkey")).agg(
        F.count(F.lit(1)).alias("n_events"), n("purchase").alias("n_purchase"), n("error").alias("n_error"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type")
    )
    out = orders.select("o_orderkey", "o_custkey").join(signals, "o_custkey", "left").drop("o_custkey")
    return out.na.fill(0, ["n_events", "n_purchase", "n_error"]).na.fill("none", ["last_type"])


def classified_quality(types: Column, priorities: Column) -> Column:
    """0.7 of the typed share and 0.3 of the prioritised share of a list of requirements."""
    n = F.size(types)
    typed = F.size(F.filter(types, lambda t: (t != "") & (t != "OTHER")))
    ranked = F.size(F.filter(priorities, lambda p: F.coalesce(p, F.lit("")) != ""))
    return F.when(n > 0, F.bround(typed / n * 0.7 + ranked / n * 0.3, 4)).otherwise(0.0)


def queries(table: Callable) -> dict[str, tuple[Callable, str]]:
    def base(spark: SparkSession, sf_dir: str) -> DataFrame:
        return listing_base(*(table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem", "events")))

    def features(spark: SparkSession, sf_dir: str) -> DataFrame:
        return listing_features(base(spark, sf_dir))

    def task_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
        row = features(spark, sf_dir)
        scores = readiness(F.col("completeness") / 100, F.col("n_requirements") > 0, F.col("n_skills") > 0, F.lit(True))
        return row.select("o_orderkey", *(c.alias(t) for t, c in scores.items()), F.array_join(blockers(scores), ",").alias("blocked"))

    def requirement_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
        return requirement_rows(*(table(spark, sf_dir, n) for n in ("lineitem", "part", "orders")))

    def signal_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
        return signal_rows(table(spark, sf_dir, "orders"), table(spark, sf_dir, "events"))

    def requirement_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = requirement_dataset(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_list("type").alias("t"), F.collect_list(F.when(F.col("confidence") > 0.05, "HIGH").otherwise("")).alias("p"))
        return rows.select("l_orderkey", classified_quality(F.col("t"), F.col("p")).alias("quality"))

    def dataset_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A row an exported column with its filled share: types from schemas, shares from one pass a table."""
        frames = {"requirements": requirement_dataset(spark, sf_dir), "signals": signal_dataset(spark, sf_dir)}
        shares = None
        for name, df in frames.items():
            one = df.agg(*(F.bround(F.count(c) / F.count(F.lit(1)), 4).alias(c) for c in df.columns)).unpivot([], df.columns, "column", "filled").withColumn("file", F.lit(name))
            shares = one if shares is None else shares.unionByName(one)
        return dictionary(spark, frames).join(shares, ["file", "column"])

    requirements_sql = """
SELECT l_orderkey, l_linenumber AS sort_order, l_partkey, l_suppkey, CASE l_returnflag WHEN 'R' THEN 'SKILL' WHEN 'A' THEN 'EXPERIENCE' ELSE 'OTHER' END AS type, p_name AS value, p_brand AS category,
  round_even(l_discount, 4) AS confidence, o_orderstatus AS listing_status FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey"""
    signals_sql = """
WITH s AS (SELECT user_id AS u, count(*) AS n_events, count(*) FILTER (event_type = 'purchase') AS n_purchase, count(*) FILTER (event_type = 'error') AS n_error, max_by(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id)
SELECT o_orderkey, coalesce(n_events, 0) AS n_events, coalesce(n_purchase, 0) AS n_purchase, coalesce(n_error, 0) AS n_error, coalesce(last_type, 'none') AS last_type FROM orders LEFT JOIN s ON u = o_custkey"""
    quality_sql = f"""
WITH r AS ({requirements_sql}) SELECT l_orderkey, round_even(count(*) FILTER (type <> 'OTHER') / count(*)::DOUBLE * 0.7::DOUBLE + count(*) FILTER (confidence > 0.05::DOUBLE) / count(*)::DOUBLE * 0.3::DOUBLE, 4) AS quality FROM r GROUP BY l_orderkey"""

    features_sql = """
WITH k AS (SELECT l_orderkey AS o, count(*) AS n_requirements, count(DISTINCT l_partkey) AS n_skills FROM lineitem GROUP BY l_orderkey),
s AS (SELECT user_id AS u, count(*) FILTER (event_type = 'purchase') AS na, count(*) FILTER (event_type = 'error') AS nr FROM events GROUP BY user_id),
b AS (SELECT o_orderkey, coalesce(n_requirements, 0) AS n_requirements, coalesce(n_skills, 0) AS n_skills, coalesce(na, 0) AS na, coalesce(nr, 0) AS nr, c_name, o_orderpriority, o_orderstatus,
  round_even(o_totalprice, 0)::BIGINT AS lo, round_even(o_totalprice * 3, 0)::BIGINT AS hi,
  round_even(((trim(c_name) <> '')::INT + (trim(c_mktsegment) <> '')::INT + (trim(o_orderpriority) <> '')::INT + (trim(o_orderstatus) <> '')::INT + (coalesce(n_requirements, 0) > 0)::INT) / 5::DOUBLE * 100, 0)::INT AS completeness
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN k ON o = o_orderkey LEFT JOIN s ON u = o_custkey),
q AS (SELECT *, (n_requirements > 0)::INT * 50 + (n_skills > 0)::INT * 40 + starts_with(o_orderpriority, '1')::INT * 10 AS fit_quality, (lo + hi) // 2 AS mid,
  ('0x' || substr(sha256(lower(o_orderpriority) || '|' || lower(trim(c_name)) || '|' || lower(o_orderstatus)), 1, 8))::BIGINT / 4294967295.0::DOUBLE AS u FROM b),
f AS (SELECT o_orderkey, n_requirements, n_skills, completeness, fit_quality, CASE WHEN n_skills > 0 THEN round_even(n_requirements / n_skills::DOUBLE, 3) END AS ratio,
  CASE WHEN na > 0 THEN 'accepted' WHEN nr > 0 THEN 'rejected' ELSE 'none' END AS tracker_state,
  CASE WHEN o_orderstatus <> 'F' AND fit_quality >= 80 THEN 'tier_1' WHEN o_orderstatus <> 'F' AND fit_quality >= 60 THEN 'tier_2' ELSE 'tier_3' END AS tier,
  CASE WHEN mid < 5000000 THEN 'low' WHEN mid < 12000000 THEN 'mid' ELSE 'high' END AS salary_bucket, CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.8::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM q)
"""
    term = lambda w, x: f"{w}::DOUBLE * {x}"
    parts = ("c", "r", "k", "1.0::DOUBLE")
    scores = {t: "round_even(" + " + ".join(term(w, x) for w, x in zip(ws, parts, strict=True) if w) + ", 4)" for t, ws in TASKS.items()}
    readiness_sql = features_sql + f"""
, p AS (SELECT o_orderkey, completeness / 100::DOUBLE AS c, (n_requirements > 0)::INT::DOUBLE AS r, (n_skills > 0)::INT::DOUBLE AS k FROM f),
t AS (SELECT o_orderkey, {", ".join(f"{e} AS {t}" for t, e in scores.items())} FROM p)
SELECT *, concat_ws(',', {", ".join(f"CASE WHEN {t} < 0.55::DOUBLE THEN '{t}' END" for t in scores)}) AS blocked FROM t"""
    more = {
        "requirement_dataset": (requirement_dataset, requirements_sql), "signal_dataset": (signal_dataset, signals_sql), "requirement_quality": (requirement_quality, quality_sql),
        "dataset_dictionary": (dataset_dictionary, None),
    }
    return more | {"listing_features": (features, features_sql + "SELECT * FROM f"), "task_readiness": (task_readiness, readiness_sql)}
