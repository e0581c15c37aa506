"""Registered queries over the given tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postings.functions import clean_html, html, identity, json, redact, requirements, roles, salary, text
from postings.operators import delivery, keyed, ledgers, quality, ranks, reports, runs, validate
from postings.plans import contracts, dataset, model_rows, relations
from postings.sources import captures, mappers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; timestamps without a zone are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- keys: latest rows, upserts, duplicates, chunks, pages


@query("""
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return keyed.latest_by(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("""
WITH last_day AS (SELECT user_id, ts::DATE AS day, max_by({'e': event_id, 't': event_type, 'v': value}, (ts, event_id)) AS r, min(event_id) FILTER (ts < TIMESTAMP '2024-01-16') AS first_id
  FROM events GROUP BY ALL)
SELECT user_id, day::VARCHAR AS day, r.e AS event_id, r.t AS event_type, r.v AS value FROM last_day""")
def upsert_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").cast("string").alias("day"), "event_id", "event_type", "value", "ts")
    split = F.lit("2024-01-16").cast("timestamp")
    stored = keyed.latest_by(rows.where(F.col("ts") < split), ["user_id", "day"], ["ts", "event_id"])
    return keyed.upsert(stored, rows.where(F.col("ts") >= split), ["user_id", "day"], ["ts", "event_id"]).drop("ts")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(*) - 1 AS surplus FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_identities(spark, sf_dir):
    return keyed.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH d AS (SELECT doc_id, sha256(text) AS k, source, lang FROM documents),
w AS (SELECT *, row_number() OVER p AS rn, lag(source) OVER p AS ps, lag(lang) OVER p AS pl FROM d WINDOW p AS (PARTITION BY k ORDER BY doc_id))
SELECT doc_id, CASE WHEN k IS NULL THEN 'quarantine' WHEN rn = 1 THEN 'insert' ELSE 'update' END AS action,
  CASE WHEN k IS NULL THEN 'missing_identity' WHEN rn = 1 THEN 'new_identity' WHEN ps <> source AND pl IS DISTINCT FROM lang THEN 'identity_collision'
    WHEN ps <> source THEN 'slug_drift' ELSE 'duplicate_identity' END AS reason FROM w""")
def dedup_decisions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("k"), "source", "lang", F.col("lang").alias("company"))
    return keyed.dedup_decisions(docs, "k", ["doc_id"], "source", "lang", "company").select("doc_id", "action", "reason")


@query("""
SELECT o_orderkey, o_orderstatus, ((row_number() OVER (PARTITION BY o_orderstatus, o_orderdate::DATE ORDER BY o_orderkey) - 1) // 25)::BIGINT AS chunk FROM orders""")
def chunk_plan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return keyed.chunks(orders, ["o_orderstatus", "day"], ["o_orderkey"], 25).select("o_orderkey", "o_orderstatus", "chunk")


@query("""
SELECT p_partkey, p_name, p_brand FROM part WHERE p_type ILIKE '%e%' OR p_name ILIKE '%e%' ORDER BY p_retailprice DESC, p_partkey LIMIT 20 OFFSET 20""")
def page_of_results(spark, sf_dir):
    part = table(spark, sf_dir, "part").where(F.col("p_type").ilike("%e%") | F.col("p_name").ilike("%e%"))
    return keyed.page(part, [F.desc("p_retailprice"), F.asc("p_partkey")], 2, 20).select("p_partkey", "p_name", "p_brand")


@query("""
WITH n AS (SELECT count(*) AS total FROM part WHERE p_name ILIKE '%e%')
SELECT total, ceil(total / 20.0)::BIGINT AS pages, ceil(total / 20.0) > 2 AS has_next, true AS has_previous FROM n""")
def page_totals(spark, sf_dir):
    return keyed.page_meta(table(spark, sf_dir, "part").where(F.col("p_name").ilike("%e%")), 2, 20)


@query("""
WITH c AS (SELECT l_orderkey, p_name, count(*) AS n, min((l_linenumber, l_partkey, l_suppkey)) AS first_at FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, first_at, p_name) AS place FROM c)
SELECT l_orderkey, p_name, n, place FROM r WHERE place <= 10""")
def top10_by_frequency(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return keyed.top_values(rows, ["l_orderkey"], "p_name", ["l_linenumber", "l_partkey", "l_suppkey"], 10).withColumn("place", F.col("place").cast("long"))


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n, min((ts, event_id)) AS first_at FROM events GROUP BY ALL)
SELECT user_id, event_type, n FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first_at, event_type) = 1""")
def top_event(spark, sf_dir):
    return keyed.top_values(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["ts", "event_id"], 1).drop("place")


# --- joins and aggregates over the star


@query("""
SELECT o_orderkey, c_name, n_name, r_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000""")
def star_listing(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    star = t("orders").where("o_orderstatus = 'O'").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    star = star.join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return star.select("o_orderkey", "c_name", "n_name", "r_name", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1000)


@query("""
SELECT l_orderkey, count(*) AS n_children, round_even(sum(l_extendedprice), 2) AS total FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY ALL""")
def child_semi_scope(spark, sf_dir):
    scope = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = table(spark, sf_dir, "lineitem").join(scope, "l_orderkey", "left_semi")
    return rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_children"), F.bround(F.sum("l_extendedprice"), 2).alias("total"))


@query("""
SELECT 'lineitem_order' AS relation, count(*) AS n FROM lineitem ANTI JOIN orders ON o_orderkey = l_orderkey
UNION ALL SELECT 'lineitem_part', count(*) FROM lineitem ANTI JOIN part ON p_partkey = l_partkey
UNION ALL SELECT 'order_customer', count(*) FROM orders ANTI JOIN customer ON c_custkey = o_custkey""")
def orphans(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    found = {
        "lineitem_order": quality.orphans(t("lineitem"), t("orders"), "l_orderkey", "o_orderkey"),
        "lineitem_part": quality.orphans(t("lineitem"), t("part"), "l_partkey", "p_partkey"),
        "order_customer": quality.orphans(t("orders"), t("customer"), "o_custkey", "c_custkey"),
    }
    return quality.union_all([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("relation"), "n") for k, df in found.items()])


@query("SELECT o_orderkey FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey")
def uncovered_listings(spark, sf_dir):
    return quality.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey")


@query("""
SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey AND e.event_type = 'purchase')
AND (NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F'))
ORDER BY o_orderdate DESC, o_orderkey LIMIT 500""")
def not_exists_pending(spark, sf_dir):
    done = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("o_custkey"))
    kinds = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("a"), F.bool_or(F.col("l_linestatus") == "F").alias("b"))
    open_ = table(spark, sf_dir, "orders").join(done, "o_custkey", "left_anti").join(kinds, "o_orderkey", "left").where(~(F.coalesce("a", F.lit(False)) & F.coalesce("b", F.lit(False))))
    return open_.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(500).select("o_orderkey")


@query("""
SELECT user_id, count(*) AS n_total, count(*) FILTER (event_type = 'purchase') AS n_purchase, count(*) FILTER (event_type = 'error') AS n_error, max(ts)::VARCHAR AS last_at,
  CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'accepted' WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'rejected' ELSE 'none' END AS state FROM events GROUP BY user_id""")
def conditional_counts(spark, sf_dir):
    n = lambda k: F.count_if(F.col("event_type") == k)
    out = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_total"), n("purchase").alias("n_purchase"), n("error").alias("n_error"), F.max("ts").cast("string").alias("last_at"))
    return out.withColumn("state", F.when(F.col("n_purchase") > 0, "accepted").when(F.col("n_error") > 0, "rejected").otherwise("none"))


@query("""
SELECT count(*) AS n_rows, count(*) FILTER (text IS NULL) AS text_null, count(*) FILTER (trim(coalesce(text, '')) = '') AS text_blank, count(*) FILTER (lang IS NULL) AS lang_null,
  count(*) FILTER (trim(coalesce(lang, '')) = '') AS lang_blank, count(*) FILTER (quality IS NULL) AS quality_null, count(*) FILTER (trim(coalesce(quality::VARCHAR, '')) = '') AS quality_blank
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def null_blank_profile(spark, sf_dir):
    return quality.null_blank_profile(table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"), ["text", "lang", "quality"])


@query("""
SELECT source, count(*) AS n_rows, count(*) FILTER (text IS NULL) AS text_null, count(*) FILTER (trim(coalesce(text, '')) = '') AS text_blank, count(*) FILTER (quality IS NULL) AS quality_null,
  count(*) FILTER (trim(coalesce(quality::VARCHAR, '')) = '') AS quality_blank FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY source""")
def profile_by_source(spark, sf_dir):
    return quality.null_blank_profile(table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"), ["text", "quality"], ["source"])


@query("""
SELECT o_orderpriority, count(*) AS total, count(k) AS with_child, count(*) - count(k) AS without_child, round_even(count(k) / count(*)::DOUBLE, 4) AS rate
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') ON k = o_orderkey GROUP BY o_orderpriority""")
def relation_coverage(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return quality.coverage(table(spark, sf_dir, "orders"), returned, "o_orderkey", "l_orderkey", "o_orderpriority")


@query("""
WITH j AS (SELECT o_orderkey, o_orderpriority, count(l_orderkey) AS n, count(*) FILTER (l_returnflag = 'N') AS other FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT coalesce(o_orderpriority, 'all') AS source, count(*) AS jobs, sum(n)::BIGINT AS children, round_even(sum(n) / count(*)::DOUBLE, 4) AS avg_children,
  round_even(sum(other) / sum(n)::DOUBLE, 4) AS other_rate, round_even(count(*) FILTER (n = 1) / count(*)::DOUBLE, 4) AS single_rate FROM j GROUP BY ROLLUP (o_orderpriority)""")
def semantic_rollup(spark, sf_dir):
    kids = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "N").alias("other"))
    jobs = table(spark, sf_dir, "orders").join(kids, "o_orderkey", "left").na.fill(0, ["n", "other"])
    share = lambda a, b: F.bround(a / b, 4)
    return jobs.rollup("o_orderpriority").agg(
        F.count(F.lit(1)).alias("jobs"), F.sum("n").alias("children"), share(F.sum("n"), F.count(F.lit(1))).alias("avg_children"),
        share(F.sum("other"), F.sum("n")).alias("other_rate"), share(F.count_if(F.col("n") == 1), F.count(F.lit(1))).alias("single_rate"),
    ).select(F.coalesce("o_orderpriority", F.lit("all")).alias("source"), "jobs", "children", "avg_children", "other_rate", "single_rate")


@query("SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY event_type")
def nearest_rank_percentiles(spark, sf_dir):
    return ranks.nearest_rank(table(spark, sf_dir, "events"), ["event_type"], "value", {"p50": 0.5, "p95": 0.95})


@query("""
SELECT l_orderkey, count(*) AS n_children, count(*) FILTER (l_returnflag = 'R') AS n_r, count(*) FILTER (l_returnflag = 'A') AS n_a, count(DISTINCT p_name) AS n_names,
  round_even(sum(round_even(l_discount * 100, 0)::BIGINT) / count(*)::DOUBLE, 2) AS avg_percent, round_even(min(l_discount), 4) AS min_confidence, round_even(max(l_discount), 4) AS max_confidence,
  string_agg(p_name, ' || ' ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, p_name) AS names_concat FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")
def per_listing_children(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    place = F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "p_name")
    names = F.transform(F.array_sort(F.collect_list(place)), lambda x: x["p_name"])  # a listing's lines are few
    return rows.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("l_returnflag") == "R").alias("n_r"), F.count_if(F.col("l_returnflag") == "A").alias("n_a"),
        F.size(F.array_distinct(names)).cast("long").alias("n_names"), F.bround(F.sum(F.bround(F.col("l_discount") * 100).cast("long")) / F.count(F.lit(1)), 2).alias("avg_percent"), F.bround(F.min("l_discount"), 4).alias("min_confidence"),
        F.bround(F.max("l_discount"), 4).alias("max_confidence"), F.array_join(names, " || ").alias("names_concat"),
    )


# --- ledgers


@query("""
WITH raw AS (SELECT doc_id, lower(trim(source)) || ':' || sha256(text) AS k, sha256(text) AS h FROM documents),
f AS (SELECT k, min(doc_id) AS first FROM raw GROUP BY k),
known AS (SELECT DISTINCT k FROM raw JOIN labels USING (doc_id) WHERE toxic = 1),
staged AS (SELECT k, min(doc_id) AS job_id FROM raw JOIN labels USING (doc_id) WHERE quality = 0 GROUP BY k)
SELECT raw.doc_id AS raw_id, CASE WHEN raw.k IS NULL THEN 'missing_identity' WHEN raw.doc_id <> first THEN 'duplicate_in_scrape_scope' WHEN known.k IS NOT NULL THEN 'existing_backend'
  WHEN job_id IS NULL THEN 'normalization_eligible' WHEN job_id % 4 = 0 THEN 'existing_normalized_synced' WHEN job_id % 4 = 1 THEN 'existing_normalized_unsynced' WHEN job_id % 4 = 2 THEN 'identity_conflict'
  ELSE 'existing_normalized_synced' END AS decision FROM raw LEFT JOIN f ON f.k = raw.k LEFT JOIN known ON known.k = raw.k LEFT JOIN staged ON staged.k = raw.k""")
def scope_first_occurrence(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("raw_id"), "source", F.sha2("text", 256).alias("external_id"), F.sha2("text", 256).alias("payload_hash"))
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "raw_id")
    consumer = raw.join(labels.where("toxic = 1"), "raw_id", "left_semi").select("source", "external_id")
    staged = raw.join(labels.where("quality = 0"), "raw_id", "left_semi").select(F.col("raw_id").alias("job_id"), "source", "external_id", F.col("payload_hash").alias("raw_hash"))
    # a delivery state for three of four jobs: sent, failed once, failed too often, none
    states = staged.select("job_id", F.when(F.col("job_id") % 4 == 0, "sent").when(F.col("job_id") % 4 < 3, "failed").alias("state"), F.when(F.col("job_id") % 4 == 2, 3).otherwise(1).alias("attempts"))
    return ledgers.eligibility(raw, consumer, staged, states, order=["raw_id"]).select("raw_id", "decision")


def _swept(spark, sf_dir):
    jobs = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last_seen_at"), F.max_by("event_type", F.struct("ts", "event_id")).alias("t"))
    jobs = jobs.select("user_id", "last_seen_at", F.when(F.col("t") == "error", "stale").otherwise("active").alias("status"), F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")).alias("source"))
    seen = table(spark, sf_dir, "events").where("event_type = 'purchase' and ts >= timestamp '2024-01-29'").select("user_id")
    return ledgers.freshness(jobs, seen, ["user_id"], F.expr(NOW))


SWEEP = """
WITH j AS (SELECT user_id, max(ts) AS last_seen_at, CASE WHEN max_by(event_type, (ts, event_id)) = 'error' THEN 'stale' ELSE 'active' END AS status, 's' || (user_id % 5) AS source FROM events GROUP BY user_id),
seen AS (SELECT DISTINCT user_id AS u FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-29'),
a AS (SELECT *, u IS NOT NULL AS s, epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_seen_at) AS age FROM j LEFT JOIN seen ON u = user_id),
b AS (SELECT *, CASE WHEN s THEN 'active' WHEN age >= 336 * 3600000000 THEN 'expired' WHEN age >= 72 * 3600000000 THEN 'stale' ELSE status END AS st FROM a),
c AS (SELECT *, CASE WHEN st = status THEN 'unchanged' WHEN s THEN 'reactivated' ELSE st END AS transition FROM b)
"""


@query(SWEEP + "SELECT user_id, st AS status, transition, (CASE WHEN s THEN TIMESTAMP '2024-01-31' ELSE last_seen_at END)::VARCHAR AS last_seen FROM c")
def freshness_sweep(spark, sf_dir):
    return _swept(spark, sf_dir).select("user_id", "status", "transition", F.col("last_seen_at").cast("string").alias("last_seen"))


@query(SWEEP + """SELECT source, count(*) FILTER (st = 'active') AS active, count(*) FILTER (transition = 'stale') AS stale, count(*) FILTER (transition = 'expired') AS expired,
  count(*) FILTER (transition = 'reactivated') AS reactivated, count(*) FILTER (transition = 'unchanged') AS unchanged, count(*) AS total FROM c GROUP BY source""")
def freshness_summary(spark, sf_dir):
    return ledgers.freshness_summary(_swept(spark, sf_dir), "source")


def _attempts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    ok = F.when(F.col("event_type") == "purchase", True).when(F.col("event_type") == "error", False)
    return events.select("user_id", F.to_date("ts").cast("string").alias("day"), F.col("ts").alias("at"), F.col("event_id").alias("attempt_id"), ok.alias("ok"), F.concat(F.lit("e"), (F.col("event_id") % 7).cast("string")).alias("error"))


DELIVERY = """
WITH a AS (SELECT user_id, ts::DATE::VARCHAR AS day, ts, event_id, CASE event_type WHEN 'purchase' THEN true WHEN 'error' THEN false END AS ok, 'e' || (event_id % 7) AS error FROM events),
f AS (SELECT user_id, day, count(*) AS attempts, count(*) FILTER (NOT ok) AS failures, coalesce(bool_or(ok), false) AS sent, max_by(error, (ts, event_id)) FILTER (NOT ok) AS last_error, max(ts) AS last_at FROM a GROUP BY ALL),
d AS (SELECT user_id, day, attempts, CASE WHEN sent THEN 'sent' WHEN failures = 0 THEN 'pending' WHEN attempts >= 3 THEN 'dead-letter' ELSE 'failed' END AS state, CASE WHEN NOT sent THEN last_error END AS error, last_at FROM f)
"""


@query(DELIVERY + "SELECT * EXCLUDE (last_at) FROM d")
def delivery_state(spark, sf_dir):
    return ledgers.delivery_state(_attempts(spark, sf_dir), ["user_id", "day"]).drop("last_at")


@query(DELIVERY + "SELECT user_id, day, attempts, state FROM d WHERE state = 'pending' OR (state = 'failed' AND attempts < 3) ORDER BY last_at DESC, user_id, day LIMIT 200")
def delivery_candidates(spark, sf_dir):
    states = ledgers.delivery_state(_attempts(spark, sf_dir), ["user_id", "day"])
    jobs = states.select("user_id", "day", "last_at")
    return ledgers.candidates(jobs, states, ["user_id", "day"], [F.desc("last_at"), F.asc("user_id"), F.asc("day")], 200).select("user_id", "day", "attempts", "state")


@query(DELIVERY + "SELECT user_id, min(day) AS first_day, count(*) AS n_sent FROM d WHERE state = 'sent' GROUP BY user_id")
def handoff_idempotent(spark, sf_dir):
    sent = ledgers.delivery_state(_attempts(spark, sf_dir), ["user_id", "day"]).where("state = 'sent'")
    # the ledger of a first run; a second one over all sent events adds only what is new
    keys = ["user_id", "day"]
    ledger = runs.handoff(sent.limit(0), sent.where("day < '2024-01-16'"), keys)
    once = ledger.unionByName(runs.handoff(ledger, sent, keys))
    return once.groupBy("user_id").agg(F.min("day").alias("first_day"), F.count(F.lit(1)).alias("n_sent"))


RUNS = """
WITH r AS (SELECT ts::DATE::VARCHAR AS run, count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS n_failed, min(ts) AS started_at, max(ts) AS finished_at, min_by(props, (ts, event_id)) FILTER (event_type = 'error') AS first_error FROM events GROUP BY ALL),
s AS (SELECT *, CASE WHEN n_failed = 0 THEN 'completed' WHEN n_failed = n_rows THEN 'failed' ELSE 'partial' END AS status, (epoch_us(finished_at) - epoch_us(started_at)) // 1000 AS duration_ms FROM r)
"""


def _runs(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("run", F.to_date("ts").cast("string"))
    return ledgers.run_rows(events, ["run"], F.col("event_type") == "error", ["ts", "event_id"], "props")


@query(RUNS + "SELECT run, n_rows, n_failed, first_error, status, duration_ms FROM s")
def run_report(spark, sf_dir):
    return _runs(spark, sf_dir).drop("started_at", "finished_at")


@query("""
SELECT 'unique_event_id' AS name, count(*) = 0 AS passed, count(*) AS violations FROM (SELECT event_id FROM events GROUP BY event_id HAVING count(*) > 1)
UNION ALL SELECT 'known_customer', count(*) = 0, count(*) FROM orders ANTI JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT 'positive_quantity', count(*) FILTER (NOT l_quantity > 0) = 0, count(*) FILTER (NOT l_quantity > 0) FROM lineitem
UNION ALL SELECT 'order_has_line', count(*) = 0, count(*) FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey""")
def invariants(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    every = F.lit(True)
    return quality.union_all([
        quality.invariant(keyed.duplicate_keys(t("events"), ["event_id"]), "unique_event_id", every),
        quality.invariant(quality.orphans(t("orders"), t("customer"), "o_custkey", "c_custkey"), "known_customer", every),
        quality.invariant(t("lineitem"), "positive_quantity", ~(F.col("l_quantity") > 0)),
        quality.invariant(quality.orphans(t("orders"), t("lineitem"), "o_orderkey", "l_orderkey"), "order_has_line", every),
    ])


@query(RUNS + """
, m AS (SELECT 'failed_share' AS metric, round_even(sum(n_failed) / sum(n_rows)::DOUBLE, 6) AS value FROM s UNION ALL SELECT 'p95_duration_ms', quantile_disc(duration_ms, 0.95)::DOUBLE FROM s
  UNION ALL SELECT 'runs', count(*)::DOUBLE FROM s)
SELECT metric, value, lower, upper, coalesce(value >= coalesce(lower, '-inf'::DOUBLE) AND value <= coalesce(upper, 'inf'::DOUBLE), false) AS passed
FROM (VALUES ('failed_share', 0.0, 0.5), ('p95_duration_ms', NULL, 90000000.0), ('runs', 1.0, NULL), ('retries', NULL, 2.0)) AS g(metric, lower, upper) LEFT JOIN m USING (metric)""")
def gates(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    one = runs.agg(F.bround(F.sum("n_failed") / F.sum("n_rows"), 6).alias("failed_share"), F.expr("percentile_disc(0.95) within group (order by duration_ms)").cast("double").alias("p95_duration_ms"), F.count(F.lit(1)).cast("double").alias("runs"))
    metrics = one.unpivot([], ["failed_share", "p95_duration_ms", "runs"], "metric", "value")
    limits = spark.createDataFrame([("failed_share", 0.0, 0.5), ("p95_duration_ms", None, 90_000_000.0), ("runs", 1.0, None), ("retries", None, 2.0)], "metric string, lower double, upper double")
    return quality.gates(metrics, limits)


# --- text, HTML, JSON, redaction, identity

SP = r"[\s\x{00A0}]+"


@query(r"""
WITH t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS plain, text FROM documents),
p AS (SELECT *, len(list_filter(regexp_split_to_array(plain, '[.!?]\s+'), lambda x: trim(x) <> ''))::BIGINT AS paragraphs, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::BIGINT AS words FROM t)
SELECT doc_id, length(plain)::BIGINT AS plain_chars, sha256(plain) AS plain_sha, paragraphs, words, CASE WHEN text = '' THEN 0 ELSE greatest(1, round_even(words * 1.35::DOUBLE, 0)) END::BIGINT AS tokens FROM p""")
def clean_text(spark, sf_dir):
    c, plain, words = F.col("text"), F.col("plain"), F.col("words")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", text.strip_tags(c).alias("plain"), text.word_count(c).alias("words"))
    return docs.select("doc_id", F.length(plain).cast("long").alias("plain_chars"), F.sha2(plain, 256).alias("plain_sha"), text.paragraph_count(c, plain).alias("paragraphs"), "words", text.token_estimate(c, words).alias("tokens"))


@query(r"""
WITH t AS (SELECT doc_id, ' ' || lower(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) || ' ') || ' ' AS p FROM documents),
h AS (SELECT doc_id, contains(p, ' dan ') OR contains(p, ' yang ') OR contains(p, ' untuk ') OR contains(p, ' pengalaman ') OR contains(p, ' kualifikasi ') OR contains(p, ' dengan ') OR contains(p, ' minimal ') AS id,
  contains(p, ' and ') OR contains(p, ' with ') OR contains(p, ' experience ') OR contains(p, ' requirements ') OR contains(p, ' ability ') OR contains(p, ' team ') AS en FROM t)
SELECT doc_id, CASE WHEN id AND en THEN 'MIXED' WHEN id THEN 'ID' WHEN en THEN 'EN' ELSE 'UNKNOWN' END AS language FROM h""")
def language_signal(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.language_signal(F.col("text"), F.lit("")).alias("language"))


@query(r"""
WITH t AS (SELECT p_partkey, list_filter(regexp_split_to_array(lower(concat_ws(' ', p_name, p_brand, p_type)), '[^a-zA-Z0-9]+'), lambda x: length(x) >= 3) AS a FROM part)
SELECT p_partkey, array_to_string(list_sort(list_distinct(a))[1:50], ' ') AS keywords FROM t""")
def keyword_tokens(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.keywords(F.col("p_name"), F.col("p_brand"), F.col("p_type")), " ").alias("keywords"))


@query(r"""
WITH m AS (SELECT doc_id, regexp_replace(regexp_replace(text, '•| - ', chr(10), 'g'), '([.;:])\s+', '\1' || chr(10), 'g') AS t FROM documents),
i AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(t, '\n+'), lambda x: trim(regexp_replace(x, '^[-*]\s+', ''))), lambda x: x <> '') AS a FROM m),
l AS (SELECT doc_id, a, list_transform(a, lambda y: lower(y)) AS b FROM i),
k AS (SELECT doc_id, list_filter(a, lambda x, n: list_position(b, b[n]) = n) AS a FROM l)
SELECT doc_id, len(a)::BIGINT AS n_items, sha256(array_to_string(a, chr(10))) AS items_sha FROM k""")
def requirement_split(spark, sf_dir):
    items = requirements.split_items(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", items.alias("a")).select("doc_id", F.size("a").cast("long").alias("n_items"), F.sha2(F.array_join("a", "\n"), 256).alias("items_sha"))


@query(rf"""
SELECT conv_id, turn, CASE WHEN regexp_matches(text, '{requirements.TECH}') OR regexp_matches(text, '{requirements.SKILL}') THEN 'SKILL' WHEN regexp_matches(text, '{requirements.EDUCATION}') THEN 'EDUCATION'
  WHEN regexp_matches(text, '{requirements.EXPERIENCE}') THEN 'EXPERIENCE' WHEN regexp_matches(text, '{requirements.RESPONSIBILITY}') THEN 'RESPONSIBILITY' ELSE 'OTHER' END AS kind,
  regexp_matches(text, '{requirements.NOISE}') AS noisy, regexp_matches(text, '{redact.EMAIL}') AS has_email FROM conversations""")
def requirement_classes(spark, sf_dir):
    c = F.col("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", requirements.requirement_class(c).alias("kind"), requirements.is_noise(c).alias("noisy"), c.rlike(redact.EMAIL).alias("has_email"))


@query(r"""
WITH a AS (SELECT page_id, html, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'),
  '(?is)<(noscript\b[^>]*>.*?</noscript|template\b[^>]*>.*?</template)\s*>', ' ', 'g'), '(?is)<(iframe\b[^>]*>.*?</iframe|svg\b[^>]*>.*?</svg)\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g') AS t FROM pages),
b AS (SELECT page_id, html, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM a),
c AS (SELECT page_id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS t FROM b)
SELECT page_id, length(t)::BIGINT AS n_chars, sha256(t) AS text_sha FROM c""")
def html_to_text_rx(spark, sf_dir):
    t = html.to_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.length(t).cast("long").alias("n_chars"), F.sha2(t, 256).alias("text_sha"))


@query(r"""
SELECT page_id, len(list_filter(regexp_extract_all(html, '<\s*/?\s*([a-zA-Z0-9]+)([^>]*)>', 1), lambda x: lower(x) NOT IN ('p', 'ul', 'ol', 'li', 'strong', 'em', 'br'))) = 0
  AND len(list_filter(regexp_extract_all(html, '<\s*/?\s*([a-zA-Z0-9]+)([^>]*)>', 2), lambda x: trim(x) <> '')) = 0
  AND NOT regexp_matches(html, '(?i)(?:<\s*/?\s*(?:script|style|iframe|object|embed|svg)\b|\bon[a-z]+\s*=|javascript\s*:)') AS safe FROM pages""")
def html_safety(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.is_safe(F.col("html")).alias("safe"))


@query(r"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host, split_part(url, '?', 1) AS bare_url, contains(url, '?') AS has_query FROM pages")
def url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", redact.host_of(F.col("url")).alias("host"), F.split("url", r"\?")[0].alias("bare_url"), F.contains("url", F.lit("?")).alias("has_query"))


@query("SELECT json_extract_string(props, '$.k')::BIGINT AS k, count(*) AS n, round_even(sum(value), 4) AS total FROM events GROUP BY 1")
def json_props(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.bround(F.sum("value"), 4).alias("total"))


@query(rf"""
SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '{redact.BEARER}', 'Bearer <redacted>', 'g'), '{redact.URL_LOGIN}', '\1://<redacted>@', 'g'),
  '{redact.COOKIE}', '\1\2=<redacted>', 'g'), '{redact.SESSION}', '\1=<redacted>', 'g')) AS redacted_sha FROM documents""")
def redacted_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(redact.redact(F.col("text")), 256).alias("redacted_sha"))


@query(rf"""
SELECT * FROM (SELECT doc_id, unnest(['bearer', 'url_login', 'session', 'email']) AS kind, unnest([len(regexp_extract_all(text, '{redact.BEARER}')), len(regexp_extract_all(text, '{redact.URL_LOGIN}')),
  len(regexp_extract_all(text, '{redact.SESSION}')), len(regexp_extract_all(text, '{redact.EMAIL}'))])::BIGINT AS n FROM documents) WHERE n > 0""")
def secret_findings(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(redact.findings(F.col("text"))).alias("f")).select("doc_id", "f.kind", "f.n")


@query("SELECT o_orderkey, sha256(lower(trim(o_orderpriority)) || ':' || lower(trim(o_orderkey::VARCHAR))) AS identity_hash FROM orders")
def identity_hash(spark, sf_dir):
    key = identity.identity_key(F.col("o_orderpriority"), F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", identity.identity_hash(key).alias("identity_hash"))


@query("""
SELECT c_custkey, sha256('{"company_name":"' || c_name || '","source_platform":"' || lower(c_mktsegment) || '","source_slug":null,"source_url":null,"title":"' || c_name || '"}') AS fingerprint FROM customer""")
def fallback_fingerprint(spark, sf_dir):
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "customer").select("c_custkey", identity.fingerprint(F.col("c_mktsegment"), none, F.col("c_name"), F.col("c_name"), none).alias("fingerprint"))


@query("""
WITH g AS (SELECT o_orderkey, lower(o_orderpriority) || '|' || lower(trim(c_name)) || '|' || lower(o_orderstatus) AS k FROM orders JOIN customer ON c_custkey = o_custkey),
u AS (SELECT *, ('0x' || substr(sha256(k), 1, 8))::BIGINT / 4294967295.0::DOUBLE AS u FROM g)
SELECT o_orderkey, CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.8::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM u""")
def split_assignment(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    key = F.concat_ws("|", F.lower("o_orderpriority"), F.lower(F.trim("c_name")), F.lower("o_orderstatus"))
    return rows.select("o_orderkey", identity.split_of(key).alias("split"))


# --- salary, roles, dataset rows


@query("""
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN (o_totalprice * 20)::BIGINT END AS lo, CASE WHEN o_orderkey % 7 > 0 THEN (o_totalprice * 30)::BIGINT END AS hi FROM orders),
m AS (SELECT *, CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN (lo + hi) // 2 ELSE coalesce(lo, hi) END AS mid FROM s)
SELECT o_orderkey, mid, CASE WHEN mid IS NULL THEN 'unknown' WHEN mid < 5000000 THEN 'low' WHEN mid < 12000000 THEN 'mid' ELSE 'high' END AS bucket,
  CASE WHEN lo IS NULL AND hi IS NULL THEN 'unknown' WHEN lo > hi THEN 'outlier' ELSE 'known' END AS signal FROM m""")
def salary_bucket(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("case when o_orderkey % 5 > 0 then cast(bround(o_totalprice * 20) as long) end").alias("lo"), F.expr("case when o_orderkey % 7 > 0 then cast(bround(o_totalprice * 30) as long) end").alias("hi"))
    return rows.select("o_orderkey", salary.midpoint(F.col("lo"), F.col("hi")).alias("mid"), salary.bucket(F.col("lo"), F.col("hi")).alias("bucket"), salary.signal(F.col("lo"), F.col("hi")).alias("signal"))


@query("""
SELECT o_orderkey, 'IDR ' || format('{:,}', o_totalprice::BIGINT) || ' - ' || format('{:,}', (o_totalprice * 2)::BIGINT) || ' / month' AS shown FROM orders""")
def salary_display(spark, sf_dir):
    whole = lambda c: F.bround(c).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", salary.display(whole(F.col("o_totalprice")), whole(F.col("o_totalprice") * 2), F.lit("IDR"), F.lit("monthly")).alias("shown"))


@query("""
SELECT p_partkey, CASE WHEN contains(t, 'engineer') OR contains(t, 'developer') OR contains(t, 'software') OR contains(t, 'backend') OR contains(t, 'frontend') THEN 'engineering'
  WHEN contains(t, 'data') OR contains(t, 'analyst') OR contains(t, 'science') OR contains(t, 'ml') OR contains(t, 'ai') THEN 'data_ai' WHEN contains(t, 'design') OR contains(t, 'ui') OR contains(t, 'ux') THEN 'design'
  WHEN contains(t, 'marketing') OR contains(t, 'sales') OR contains(t, 'business development') THEN 'growth' ELSE 'other' END AS family FROM (SELECT p_partkey, lower(p_name || ' ' || p_type) AS t FROM part)""")
def role_families(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", roles.role_family(F.concat_ws(" ", "p_name", "p_type")).alias("family"))


# --- captured pages, written by the query from orders in each source's envelope and read back


def _pages(orders: DataFrame, source: str) -> DataFrame:
    """Pages of 25 orders as a source would send them; every 20th order has no id, every 50th page no list."""
    # entries are built after the shuffle, which carries only what they are made of
    entry = lambda x: F.struct(
        F.when(x["k"] % 20 > 0, x["k"].cast("string")).alias("id"), F.concat(F.lit("s-"), x["k"].cast("string")).alias("slug"), x["p"].alias("positionName"), F.struct(x["s"].alias("name")).alias("company")
    )
    kept = F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"))
    page = orders.groupBy(F.floor(F.col("o_orderkey") / 125).alias("page_id")).agg(F.sort_array(F.collect_list(kept)).alias("a"))
    text = F.to_json(F.transform("a", entry))
    wrap = {
        "source_a": ('{"data":{"docs":', "}}"), "source_b": ('{"data":{"searchJobsV3":{"hasMore":true,"jobsInPage":', "}}}"), "source_c": ('{"data":{"jobSearchV6":{"totalCount":1,"data":', "}}}"),
        "source_d": ('{"pageProps":{"jobs":', "}}"), "source_e": ('{"data":{"vacanciesV4":{"list":', "}}}"),
    }[source]
    return page.select("page_id", F.when(F.col("page_id") % 50 == 0, F.lit('{"data":{}}')).otherwise(F.concat(F.lit(wrap[0]), text, F.lit(wrap[1]))).alias("payload"))


CAPTURED = """
WITH o AS (SELECT 'source_' || ['a', 'b', 'c', 'd', 'e'][(o_orderkey % 5 + 1)::INT] AS source, o_orderkey // 125 AS page_id, o_orderkey FROM orders),
p AS (SELECT *, (row_number() OVER (PARTITION BY source, page_id ORDER BY o_orderkey) - 1)::INT AS position FROM o)
"""


def _captured(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return [captures.parse_pages(_pages(orders.where(F.col("o_orderkey") % 5 == i), s), s) for i, s in enumerate(captures.ENVELOPES)]


@query(CAPTURED + "SELECT source, page_id, position, o_orderkey::VARCHAR AS external_id FROM p WHERE page_id % 50 <> 0 AND o_orderkey % 20 <> 0")
def capture_rows(spark, sf_dir):
    return quality.union_all([rows.drop("payload") for rows, _ in _captured(spark, sf_dir)])


@query(CAPTURED + """SELECT source, page_id, position, 'missing_id' AS reason FROM p WHERE page_id % 50 <> 0 AND o_orderkey % 20 = 0
UNION ALL SELECT DISTINCT source, page_id, NULL::INT, 'missing_list' FROM p WHERE page_id % 50 = 0""")
def capture_rejects(spark, sf_dir):
    return quality.union_all([rejects for _, rejects in _captured(spark, sf_dir)])


def _mapped(spark, sf_dir):
    """Orders as list entries of source_c, mapped to canonical records; every 9th order has no company."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    millions = (F.col("o_orderkey") % 30 + 1).cast("string")
    entry = F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("  "), "o_orderpriority", F.lit("  role ")).alias("title"), F.when(F.col("o_orderkey") % 9 > 0, F.col("c_name")).alias("companyName"),
        F.concat(F.lit("Rp "), millions, F.lit(" - 5 juta per bulan")).alias("salaryLabel"), F.array(F.struct(F.concat("c_mktsegment", F.lit(", Java")).alias("label"))).alias("locations"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dateTimeUtc")).alias("listingDate"), F.array(F.lit("Full time")).alias("workTypes"),
    )
    raw = orders.select(F.lit("source_c").alias("source"), F.col("o_orderkey").cast("string").alias("external_id"), F.to_json(entry).alias("payload"), F.expr(NOW).alias("scraped_at"))
    return mappers.map_source(raw, "source_c")


MAPPED = """
WITH m AS (SELECT o_orderkey::VARCHAR AS external_id, o_orderpriority || ' role' AS title, CASE WHEN o_orderkey % 9 > 0 THEN c_name END AS company, (o_orderkey % 30 + 1) * 1000000 AS x, c_mktsegment AS city,
  o_orderdate::DATE::VARCHAR AS posted FROM orders JOIN customer ON c_custkey = o_custkey)
"""


@query(MAPPED + """SELECT external_id, title, company, least(x, 5000000)::BIGINT AS min_amount, greatest(x, 5000000)::BIGINT AS max_amount, 'IDR' AS currency, 'monthly' AS period, city, 'Java' AS region, posted,
  'full_time' AS employment_type, 'active' AS status FROM m WHERE company IS NOT NULL""")
def canonical_rows(spark, sf_dir):
    good, _ = validate.split_valid(_mapped(spark, sf_dir), validate.canonical_rules())
    return good.select("external_id", "title", "company", "salary.min_amount", "salary.max_amount", "salary.currency", "salary.period", "location.city", "location.region", F.date_format("posted_at", "yyyy-MM-dd").alias("posted"), "employment_type", "status")


@query(MAPPED + "SELECT external_id, 'missing_company' AS message, 'company' AS field, 'open' AS status FROM m WHERE company IS NULL")
def quarantined_rows(spark, sf_dir):
    _, bad = validate.split_valid(_mapped(spark, sf_dir), validate.canonical_rules())
    return validate.quarantine_rows(bad, ["external_id"], F.expr(NOW)).select("external_id", "message", "field", "status")


@query("""SELECT event_id, sha256('{"event_type":"' || event_type || '","props":' || to_json(props) || ',"user_id":' || user_id || '}') AS row_hash FROM events""")
def row_fingerprint(spark, sf_dir):
    fields = {c: F.col(c) for c in ("user_id", "event_type", "props")}
    return table(spark, sf_dir, "events").select("event_id", json.struct_hash(fields).alias("row_hash"))


@query("SELECT event_id, sha256('{\"k\":' || json_extract_string(props, '$.k') || '}') AS payload_hash, json_extract_string(props, '$.k') AS k FROM events")
def payload_hashes(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", json.payload_hash(F.col("props")).alias("payload_hash"), json.find_key(F.col("props"), ("k",)).alias("k"))


@query()
def sanitised_pages(spark, sf_dir):
    clean = clean_html.sanitise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", clean.alias("display"), clean_html.full_text(F.col("html")).alias("text"), html.is_safe(clean).alias("safe"))


# --- delivery and reports

PAYLOADS = """
WITH p AS (SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, '{"externalId":"' || o_orderkey || '","status":"' || CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'HIDDEN' END
  || '","title":"' || upper(replace(replace(o_orderpriority, '-', '_'), ' ', '_')) || '"}' AS payload FROM orders)
"""


def _payloads(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "F", "expired")
    rows = delivery.payloads(orders, {"externalId": F.col("o_orderkey").cast("string"), "status": delivery.status_code(status), "title": delivery.code(F.col("o_orderpriority"))}, "o_orderkey")
    return rows.join(orders.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("day")), "o_orderkey")


@query(PAYLOADS + "SELECT o_orderkey, payload, sha256(payload) AS payload_hash, day FROM p")
def delivery_payloads(spark, sf_dir):
    return _payloads(spark, sf_dir)


@query(PAYLOADS + """
, c AS (SELECT *, (row_number() OVER (PARTITION BY day ORDER BY o_orderkey) - 1) // 25 AS chunk FROM p),
b AS (SELECT day, chunk::BIGINT AS chunk, count(*) AS n, '[' || string_agg(payload, ',' ORDER BY o_orderkey) || ']' AS body FROM c GROUP BY ALL)
SELECT day, chunk, n, sha256(body) AS chunk_hash FROM b""")
def delivery_batches(spark, sf_dir):
    return delivery.batches(_payloads(spark, sf_dir), ["day"], ["o_orderkey"], 25).drop("body")


@query("""
WITH o AS (SELECT ts::DATE::VARCHAR AS run, CASE event_type WHEN 'purchase' THEN 200 WHEN 'error' THEN [404, 422, 503][(event_id % 3 + 1)::INT] END AS status FROM events WHERE event_type IN ('purchase', 'error', 'login')),
c AS (SELECT run, CASE WHEN status IS NULL THEN 'retryable' WHEN status BETWEEN 200 AND 299 THEN 'sent' WHEN status = 404 THEN 'retryable' WHEN status BETWEEN 400 AND 499 THEN 'final' ELSE 'retryable' END AS outcome FROM o)
SELECT run, outcome, count(*) AS n FROM c GROUP BY ALL""")
def delivery_outcomes(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("event_type in ('purchase', 'error', 'login')")
    status = F.when(F.col("event_type") == "purchase", 200).when(F.col("event_type") == "error", F.get(F.array(F.lit(404), F.lit(422), F.lit(503)), (F.col("event_id") % 3).cast("int")))
    return events.groupBy(F.to_date("ts").cast("string").alias("run"), delivery.outcome(status).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH e AS (SELECT user_id, sum((event_type = 'error')::INT) AS k FROM events GROUP BY user_id)
SELECT user_id, greatest(1, floor(100 / pow(2, least(k, 10))))::INT AS chunk_size FROM e""")
def chunk_size_plan(spark, sf_dir):
    attempts = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.when(F.col("event_type") == "error", 503).otherwise(200).alias("status"))
    return delivery.halved_sizes(attempts, ["user_id"], ["ts", "event_id"], 100)


@query("""
WITH r AS (SELECT 'run-' || (user_id % 40) || CASE event_id % 3 WHEN 0 THEN '-sync' WHEN 1 THEN '-retry-0' || (event_id % 7 + 1) ELSE '' END AS run FROM events),
b AS (SELECT regexp_replace(run, '(-(scrape|normalize|enrich|sync|notify))?(-retry-[0-9]+)?$', '') AS base, regexp_matches(run, '-retry-[0-9]+$') AS retry FROM (SELECT DISTINCT run FROM r))
SELECT base, base || '-retry-' || lpad((count(*) FILTER (retry) + 1)::VARCHAR, 2, '0') AS next_run FROM b GROUP BY base""")
def retry_run_ids(spark, sf_dir):
    suffix = F.when(F.col("event_id") % 3 == 0, "-sync").when(F.col("event_id") % 3 == 1, F.concat(F.lit("-retry-0"), (F.col("event_id") % 7 + 1).cast("string"))).otherwise("")
    runs = table(spark, sf_dir, "events").select(F.concat(F.lit("run-"), (F.col("user_id") % 40).cast("string"), suffix).alias("run")).distinct()
    return delivery.next_retry_id(runs, "run")


@query("""
WITH d AS (SELECT o_custkey AS k, max_by({'p': CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END, 's': CASE o_orderstatus WHEN 'O' THEN 200 WHEN 'F' THEN 404 ELSE 503 END}, CASE o_orderstatus WHEN 'O' THEN 200 WHEN 'F' THEN 404 ELSE 503 END) AS d
  FROM (SELECT o_custkey, o_orderstatus, min(o_orderpriority) AS o_orderpriority FROM orders GROUP BY ALL) GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN d.p IS NOT NULL THEN 'complete' ELSE 'partial' END AS completeness, CASE WHEN d.p IS NOT NULL THEN NULL WHEN k IS NULL THEN 'not_attempted' WHEN d.s = 404 THEN 'not_found' ELSE 'source_error' END AS missing_reason
FROM customer LEFT JOIN d ON k = c_custkey""")
def list_with_detail(spark, sf_dir):
    detail = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus").agg(F.min("o_orderpriority").alias("p"))
    status = F.when(F.col("o_orderstatus") == "O", 200).when(F.col("o_orderstatus") == "F", 404).otherwise(503)
    detail = detail.select("c_custkey", F.when(F.col("o_orderstatus") == "O", F.col("p")).alias("payload"), status.alias("status"))
    return delivery.with_detail(table(spark, sf_dir, "customer").select("c_custkey"), detail, "c_custkey", "status").select("c_custkey", "completeness", "missing_reason")


QUALITY = """
WITH w AS (SELECT lang, count(*)::DOUBLE AS jobs, avg((length(text) < 500)::INT)::DOUBLE AS short, (count(*) FILTER (contains(lower(text), 'license')))::DOUBLE AS noisy, grouping(lang) AS g FROM documents GROUP BY ROLLUP (lang)),
m AS (SELECT CASE WHEN g = 1 THEN 'all' ELSE coalesce(lang, 'unknown') END AS scope, unnest(['jobs', 'short_rate', 'noisy']) AS metric, unnest([jobs, round_even(short, 4), noisy]) AS value FROM w)
"""


def _quality(spark, sf_dir):
    short, noisy = F.length("text") < 500, F.contains(F.lower("text"), F.lit("license"))
    values = {"jobs": F.count(F.lit(1)), "short_rate": F.bround(F.avg(short.cast("int")), 4), "noisy": F.count_if(noisy)}
    return reports.metrics(table(spark, sf_dir, "documents"), F.col("lang"), values)


@query(QUALITY + "SELECT * FROM m")
def quality_metrics(spark, sf_dir):
    return _quality(spark, sf_dir)


@query(QUALITY + """SELECT scope, 'many_short' AS name, 'warning' AS severity, value FROM m WHERE metric = 'short_rate' AND value > 0.1
UNION ALL SELECT scope, 'noise', 'critical', value FROM m WHERE metric = 'noisy' AND value > 3""")
def quality_warnings(spark, sf_dir):
    return reports.warnings(_quality(spark, sf_dir), [("many_short", "short_rate", "warning", 0.1), ("noise", "noisy", "critical", 3.0)])


@query("""
SELECT coalesce(nullif(trim(CASE conv_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'm' || (conv_id % 4) END), ''), 'unknown') AS model, count(*) AS requests, count(*) FILTER (role IN ('user', 'assistant')) AS successes,
  count(*) FILTER (role = 'other') AS failed, count(*) FILTER (role = 'system') AS rate_limited FROM conversations GROUP BY 1""")
def model_usage(spark, sf_dir):
    model = F.when(F.col("conv_id") % 4 == 0, "").when(F.col("conv_id") % 4 > 1, F.concat(F.lit("m"), (F.col("conv_id") % 4).cast("string")))
    status = F.when(F.col("role") == "user", "success").when(F.col("role") == "assistant", "succeeded").when(F.col("role") == "system", "rate_limited").otherwise("failed")
    return reports.model_usage(table(spark, sf_dir, "conversations"), model, status)


@query("""
SELECT event_type, json_extract_string(props, '$.k')::INT % 5 AS endpoint, count(*) AS n FROM events WHERE event_type IN ('error', 'login') GROUP BY ALL""")
def failure_categories(spark, sf_dir):
    endpoint = (F.get_json_object("props", "$.k").cast("int") % 5).alias("endpoint")
    return reports.failure_summary(table(spark, sf_dir, "events"), F.col("event_type").isin("error", "login"), [F.col("event_type"), endpoint])


# --- runs, pages, work items, set differences


@query("""
SELECT event_id FROM events WHERE event_type = 'error' AND event_id % 4 IN (0, 1) AND event_id % 5 < 3 AND ts <= TIMESTAMP '2024-01-31' ORDER BY ts, event_id LIMIT 50""")
def ready_work(spark, sf_dir):
    status = F.element_at(F.array(*map(F.lit, ("pending", "failed", "running", "done"))), (F.col("event_id") % 4 + 1).cast("int"))
    items = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("type"), status.alias("status"), F.col("ts").alias("available_at"), (F.col("event_id") % 5).alias("attempts"))
    return runs.ready_work(items, "error", F.expr(NOW), ["available_at", "event_id"], 50).select("event_id")


@query("""
WITH w AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'completed' WHEN event_id % 5 >= 3 THEN 'dead-letter' ELSE 'failed' END AS status, ts, event_id % 5 AS n FROM events)
SELECT event_id, status, CASE WHEN status = 'failed' THEN (ts + to_seconds(60 * n))::VARCHAR END AS available_at FROM w""")
def work_states(spark, sf_dir):
    n = F.col("event_id") % 5
    state = runs.work_state(F.col("event_type") == "purchase", n, F.col("ts"), F.make_dt_interval(secs=n * 60))
    return table(spark, sf_dir, "events").select("event_id", state.alias("s")).select("event_id", "s.status", F.col("s.available_at").cast("string").alias("available_at"))


@query("""
SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'failed' WHEN bool_or(event_type = 'login') THEN 'partial' ELSE 'completed' END AS status FROM events GROUP BY user_id""")
def worst_stage_status(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "login", "partial").otherwise("completed")
    return runs.worst_status(table(spark, sf_dir, "events"), ["user_id"], status)


@query("""
WITH e AS (SELECT ts::DATE::VARCHAR AS run, ts, event_id, event_type, CASE WHEN event_id % 3 > 0 THEN props END AS setting, event_id % 10 AS pages FROM events),
c AS (SELECT run, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS stops FROM (SELECT run, event_type, count(*) AS n FROM e GROUP BY ALL) GROUP BY run)
SELECT run, min_by(setting, (ts, event_id)) FILTER (setting IS NOT NULL) AS setting, min(ts)::VARCHAR AS first_at, max(ts)::VARCHAR AS last_at, sum(pages)::BIGINT AS pages, any_value(stops) AS stops
FROM e JOIN c USING (run) GROUP BY run""")
def metadata_rollup(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("run"), "ts", "event_id", "event_type", F.when(F.col("event_id") % 3 > 0, F.col("props")).alias("setting"), (F.col("event_id") % 10).alias("pages"))
    out = runs.metadata_rollup(events, ["run"], ["ts", "event_id"], "ts", ["setting"], ["pages"], "event_type")
    stops = F.array_join(F.transform(F.map_entries("histogram"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    return out.select("run", "setting", F.col("first_at").cast("string").alias("first_at"), F.col("last_at").cast("string").alias("last_at"), "pages", stops.alias("stops"))


@query("""
SELECT user_id % 7 AS model, count(*) FILTER (event_type IN ('click', 'view')) AS requests, count(*) FILTER (event_type = 'error') AS failed FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY 1""")
def merged_counters(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("model", F.col("user_id") % 7)
    asked = events.where("event_type in ('click', 'view')").groupBy("model").agg(F.count(F.lit(1)).alias("requests"))
    lost = events.where("event_type = 'error'").groupBy("model").agg(F.count(F.lit(1)).alias("failed"))
    return runs.merge_counters([asked, lost], ["model"], ["requests", "failed"])


@query("""
SELECT o_orderpriority AS source, o_orderstatus AS keyword, count(*) AS attempted, count(*) FILTER (o_orderkey % 5 > 0) AS succeeded, count(*) FILTER (o_orderkey % 5 = 0) AS failed,
  sum(o_orderkey % 3)::BIGINT AS deduped, sum(o_orderkey % 2)::BIGINT AS truncated, max_by('stop-' || (o_orderkey % 4), o_orderkey) AS stop_reason FROM orders GROUP BY ALL""")
def page_coverage(spark, sf_dir):
    k = F.col("o_orderkey")
    pages = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("keyword"), k, (k % 5 > 0).alias("ok"), (k % 3 + 10).alias("n_rows"), F.lit(10).alias("n_kept"),
        (k % 2).alias("n_truncated"), F.concat(F.lit("stop-"), (k % 4).cast("string")).alias("stop_reason"),
    )
    return runs.page_coverage(pages, ["source", "keyword"], ["o_orderkey"])


@query("""
WITH c AS (SELECT source, sha256(text) AS k, count(*) AS n FROM documents GROUP BY ALL) SELECT source, sum(n - 1)::BIGINT AS dropped FROM c GROUP BY source""")
def page_duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", F.sha2("text", 256).alias("external_id"), "doc_id", "lang")
    return runs.dedup_pages(rows, ["source"], "external_id", ["doc_id"])[1]


@query("""
WITH m AS (SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)) SELECT (SELECT count(*) FROM m) AS n, (SELECT array_to_string(list(doc_id ORDER BY doc_id), ',') FROM (SELECT doc_id FROM m ORDER BY doc_id LIMIT 20)) AS first""")
def missing_decisions(spark, sf_dir):
    out = runs.missing_ids(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return out.select("n", F.array_join(F.transform("first", lambda x: x.cast("string")), ",").alias("first"))


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT user_id AS k FROM events)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'enabled_only' ELSE 'present_only' END AS side FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def source_differences(spark, sf_dir):
    enabled, present = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "events").select(F.col("user_id").alias("k"))
    return runs.differences(enabled, present, "k", "enabled_only", "present_only")


@query("SELECT source, count(*) AS n, least(count(*), 25) AS target FROM documents GROUP BY source")
def sample_targets(spark, sf_dir):
    return runs.sample_targets(table(spark, sf_dir, "documents"), "source", 25)


@query("""
WITH r AS (SELECT user_id, event_type, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS ms FROM events GROUP BY ALL)
SELECT user_id, max(ms) FILTER (event_type = 'click') AS click_ms, max(ms) FILTER (event_type = 'view') AS view_ms, max(ms) FILTER (event_type = 'purchase') AS purchase_ms FROM r GROUP BY user_id""")
def stage_durations(spark, sf_dir):
    stages = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"))
    return runs.stage_durations(stages, "user_id", "event_type", ["click", "view", "purchase"])


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'FETCH_ERROR' WHEN 'login' THEN 'PARSE_ERROR' WHEN 'purchase' THEN 'SYNC_ERROR' ELSE 'SCRAPER_ERROR' END AS category,
  CASE WHEN event_id % 10 = 0 THEN false ELSE event_type IN ('error', 'purchase') END AS retryable FROM events""")
def error_classes(spark, sf_dir):
    stage = F.when(F.col("event_type") == "error", "fetch").when(F.col("event_type") == "login", "parse").when(F.col("event_type") == "purchase", "sync").otherwise("other")
    found = runs.error_class(stage, F.when(F.col("event_id") % 10 == 0, False))
    return table(spark, sf_dir, "events").select("event_id", found.alias("e")).select("event_id", "e.category", "e.retryable")


@query("""
WITH k AS (SELECT p_partkey, list_filter(list_transform(string_split(replace(p_type, ' ', ', ,') || ',' || lower(p_type), ','), lambda x: trim(x)), lambda x: x <> '') AS a FROM part),
l AS (SELECT p_partkey, a, list_transform(a, lambda y: lower(y)) AS b FROM k)
SELECT p_partkey, array_to_string(list_filter(a, lambda x, n: list_position(b, b[n]) = n), '|') AS keywords FROM l""")
def keyword_lists(spark, sf_dir):
    given = F.concat(F.replace("p_type", F.lit(" "), F.lit(", ,")), F.lit(","), F.lower("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(runs.keyword_list(given), "|").alias("keywords"))


@query("""
WITH g AS (SELECT event_id, ts - to_hours(7) AS naive, ts AS aware FROM events) SELECT event_id, naive::VARCHAR AS naive, aware::VARCHAR AS aware FROM g""")
def since_literals(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    read = table(spark, sf_dir, "events").select("event_id", runs.since(iso, "Asia/Jakarta").alias("naive"), runs.since(F.concat(iso, F.lit("Z")), "Asia/Jakarta").alias("aware"))
    return read.select("event_id", F.col("naive").cast("string").alias("naive"), F.col("aware").cast("string").alias("aware"))


@query("""
WITH a AS (SELECT l_orderkey, list(p_brand ORDER BY l_linenumber, l_partkey, l_suppkey, p_brand) AS every, list(DISTINCT p_brand) FILTER (l_returnflag = 'R') AS needed FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(list_filter(every, lambda x: NOT list_contains(coalesce(needed, []), x)), '|') AS optional FROM a""")
def optional_skills(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", "p_brand")
    lists = rows.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["p_brand"]).alias("every"), F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("p_brand"))).alias("some"))
    return lists.select("l_orderkey", F.array_join(runs.ordered_difference(F.col("every"), F.col("some")), "|").alias("optional"))


@query("""
SELECT n_name AS source, r_name = 'ASIA' AS selected, CASE r_name WHEN 'ASIA' THEN NULL WHEN 'EUROPE' THEN 'disabled' WHEN 'AMERICA' THEN 'not_requested' ELSE 'unknown_source' END AS reason
FROM nation JOIN region ON r_regionkey = n_regionkey""")
def source_selection(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")).withColumn("source", F.col("n_name"))
    config = nation.where("r_name in ('ASIA', 'EUROPE', 'AMERICA')").select("source", (F.col("r_name") != "EUROPE").alias("enabled"), (F.col("r_name") != "AMERICA").alias("requested"))
    return runs.select_sources(nation.select("source"), config)


for _name, (_query, _sql) in (dataset.queries(table) | relations.queries(table) | contracts.queries(table) | model_rows.queries(table)).items():
    QUERIES[_name] = _query
    if _sql:
        ORACLES[_name] = _sql
