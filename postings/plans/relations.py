"""Skill, requirement and wording queries over the given tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.functions import requirements, skills, wording
from postings.operators import checks
from postings.sources import embedded


def skill_rows(children: DataFrame, entries: DataFrame, listings: DataFrame) -> DataFrame:
    """A row a skill of a listing: children (listing, skill, confidence), entries (skill, name, category), listings (listing, status, last_seen); a zero confidence is left out."""
    return skill_columns(children.join(entries, "skill").join(listings, "listing"))


def skill_columns(row: DataFrame) -> DataFrame:
    """The columns of skill rows over children that have their entry's and their listing's columns."""
    slug = F.regexp_replace(F.lower(F.trim("name")), "[^a-z0-9]+", "-")
    kept = F.when(F.col("confidence") != 0, F.col("confidence"))
    return row.select("listing", "skill", F.trim("name").alias("name"), slug.alias("slug"), F.trim("category").alias("category"), kept.alias("confidence"), F.upper("status").alias("status"), "last_seen")


def _case(x: str) -> str:
    spelt = {n.lower(): n for n in skills.NAMES} | skills.SPELLINGS
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in spelt.items()) + " END"


def _once(a: str) -> str:
    """SQL for an array's entries without those whose lower case stood earlier; blanks are left out."""
    return f"list_filter({a}, lambda z, n: z <> '' AND list_position(list_transform({a}, lambda u: lower(u)), lower(z)) = n)"


def _terms(text: str) -> str:
    found = f"list_filter(list_transform(regexp_extract_all({text}, '{requirements.TECH}', 1), lambda w: {_case('lower(w)')}), lambda w: w IS NOT NULL)"
    return f"list_filter({found}, lambda w, n: list_position({found}, w) = n)"


_SPACE = r"[\s\x{0B}\x{85}\p{Z}]+"
_CLEAN = f"nullif(trim(regexp_replace(x, '{_SPACE}', ' ', 'g')), '')"
_BARE = _CLEAN.replace("(x,", r"(regexp_replace(x, '^\s*[-*]\s+', ''),")
_IN = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"
_LOW = (
    f"(trim(lower(x), ' .') IN {_IN(skills.EMPTY_WHOLE)} OR regexp_matches(trim(lower(x), ' .'), '{skills.EMPTY_PARTS}') OR regexp_matches(trim(lower(x), ' .'), '{skills.EMPTY_BEGIN}')"
    f" OR (regexp_matches(trim(lower(x), ' .'), '{skills.EMPTY_END}') AND len(regexp_split_to_array(trim(lower(x), ' .'), ' +')) <= 6)"
    f" OR (len(regexp_extract_all(x, '{skills.TOKEN}')) < {skills.FEWEST} AND NOT regexp_matches(trim(x), '^(?:{requirements.TECH})$')))"
)
_KIND = (
    f"CASE WHEN regexp_matches(v, '{requirements.TECH}') OR regexp_matches(v, '{requirements.SKILL}') THEN 'SKILL' WHEN regexp_matches(v, '{requirements.EDUCATION}') THEN 'EDUCATION'"
    f" WHEN regexp_matches(v, '{requirements.EXPERIENCE}') THEN 'EXPERIENCE' WHEN regexp_matches(v, '{requirements.RESPONSIBILITY}') THEN 'RESPONSIBILITY' ELSE 'OTHER' END"
)
_ITEMS = rf"""
WITH c0 AS (SELECT conv_id, turn, role, regexp_replace(regexp_replace(regexp_replace(text, '[\x{{2600}}-\x{{27BF}}\x{{1F300}}-\x{{1FAFF}}\x{{200B}}-\x{{200F}}\x{{2060}}\x{{FE0E}}\x{{FE0F}}]', '', 'g'), '<[^>]+>', ' ', 'g'), '•| - ', chr(10), 'g') AS t, text FROM conversations),
c1 AS (SELECT *, regexp_split_to_array(regexp_replace(regexp_replace(t, '{skills.HEADINGS}', chr(10), 'g'), '([.;:])\s+|(?:^|\s)[-*]\s+', '\1' || chr(10), 'g'), '\n+') AS p FROM c0),
c2 AS (SELECT *, flatten(list_transform(p, lambda x: CASE WHEN len(regexp_extract_all(x, ',')) >= 2 AND length(x) >= 120 THEN string_split(x, ',') ELSE [x] END)) AS q FROM c1),
c3 AS (SELECT *, list_filter(list_transform(q, lambda x: {_BARE}), lambda x: x IS NOT NULL AND NOT {_LOW} AND NOT regexp_matches(x, '{requirements.NOISE}')) AS k FROM c2),
c4 AS (SELECT *, list_transform(k, lambda x: rtrim(x, '.')) AS r FROM c3),
c5 AS (SELECT conv_id, turn, role, text, {_once("r")} AS items FROM c4)
"""


def queries(table: Callable) -> dict[str, tuple[Callable, str | None]]:
    def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", skills.items(F.col("text")).alias("items"))

    def joined(c: Column) -> Column:
        return F.array_join(c, "|")

    def requirement_items(spark, sf_dir):
        return turns(spark, sf_dir).select("conv_id", "turn", F.size("items").cast("long").alias("n_items"), joined(F.col("items")).alias("items"))

    def requirement_fallbacks(spark, sf_dir):
        found = turns(spark, sf_dir).select("conv_id", "turn", skills.fallback_requirements(F.col("role"), F.filter("items", lambda x: F.length(x) >= 60), F.col("items")).alias("r"))
        return found.select("conv_id", "turn", joined(F.transform("r", lambda x: x["type"])).alias("types"), joined(F.transform("r", lambda x: x["value"])).alias("vals"))

    def requirement_summaries(spark, sf_dir):
        return turns(spark, sf_dir).select("conv_id", "turn", skills.summary(F.col("items"), F.array("role")).alias("html"))

    def canonical_skills(spark, sf_dir):
        return table(spark, sf_dir, "documents").select("doc_id", skills.canonical_terms(F.col("text")).alias("a")).select("doc_id", F.size("a").cast("long").alias("n_terms"), joined(F.col("a")).alias("terms"))

    def staged(spark, sf_dir):
        values = F.array(F.replace("p_type", F.lit(" "), F.lit(" and ")), F.col("p_brand"), F.replace("p_name", F.lit(" "), F.lit(" / ")), F.lit("Golang & Kubernetes"))
        return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", skills.sanitised_skills(values).alias("found"))

    def skill_values(spark, sf_dir):
        return staged(spark, sf_dir).select("p_partkey", joined(F.col("found")).alias("found"))

    def skill_fallbacks(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").select("doc_id", skills.fallback_skills(F.lit(None).cast("string"), F.col("source"), F.col("text")).alias("a"))
        return docs.select("doc_id", joined(F.col("a")).alias("found"))

    def enrichment_rows(spark, sf_dir):
        rows = turns(spark, sf_dir).select("conv_id", "turn", skills.enrichment(skills.canonical_terms(F.col("text")), skills.typed(F.col("items"))).alias("r"))
        return rows.select("conv_id", "turn", F.posexplode("r").alias("place", "e")).select("conv_id", "turn", F.col("place").cast("long").alias("place"), "e.kind", "e.type", "e.value", "e.confidence")

    def skill_dataset(spark, sf_dir):
        t = lambda n: table(spark, sf_dir, n)
        children = t("lineitem").select(F.col("l_orderkey").alias("listing"), F.col("l_partkey").alias("skill"), F.bround("l_discount", 4).alias("confidence"))
        entries = t("part").select(F.col("p_partkey").alias("skill"), F.col("p_name").alias("name"), F.col("p_type").alias("category"))
        return skill_rows(children, entries, t("orders").select(F.col("o_orderkey").alias("listing"), F.lower("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_seen")))

    def unmarked_texts(spark, sf_dir):
        told = F.concat(F.lit("Persyaratan: "), F.col("text"), F.lit(" Rewritten in Indonesian. Done."))
        return table(spark, sf_dir, "conversations").select("conv_id", "turn", wording.without_meta(told).alias("text"), wording.without_prefix(told).alias("bare"))

    def grounded_values(spark, sf_dir):
        return table(spark, sf_dir, "part").select("p_partkey", wording.grounded(F.col("p_type"), F.col("p_name")).alias("type_in_name"), wording.grounded(F.substring_index("p_name", " ", -1), F.col("p_name")).alias("last_in_name"))

    def limited_summaries(spark, sf_dir):
        c = F.col
        row = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey"))
        company, place = F.when(c("c_custkey") % 3 != 0, c("c_mktsegment")), F.when(c("c_custkey") % 5 != 0, c("n_name"))
        return row.select("c_custkey", *(wording.limited_summary(c("c_name"), company, place, F.lit(" "), lang).alias(lang) for lang in ("english", "indonesian")))

    def home_countries(spark, sf_dir):
        c = F.col
        row = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), c("s_nationkey") == c("n_nationkey"))
        return row.select("s_suppkey", wording.home_country(F.when(c("s_suppkey") % 4 == 0, c("n_name")), c("s_name"), c("n_name")).alias("country"), wording.location_key(c("s_name"), F.lit(" "), c("n_name")).alias("place"))

    def source_names(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").withColumn("slug", F.when(F.col("doc_id") % 7 == 0, " JobStreet ").otherwise(F.col("source")))
        return docs.groupBy(wording.source_name(F.col("slug")).alias("name")).agg(F.count(F.lit(1)).alias("n"))

    def missing_contexts(spark, sf_dir):
        kids = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_returnflag").alias("flags"))
        row = table(spark, sf_dir, "orders").join(kids, "o_orderkey", "left")
        few = F.filter("flags", lambda f: f == "R")
        return row.select("o_orderkey", F.array_join(wording.missing_context(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise("x"), F.col("flags"), few), ",").alias("missing"))

    def strict_run_checks(spark, sf_dir):
        t = lambda n: table(spark, sf_dir, n)
        events = t("events").where(F.col("user_id").isNotNull()).withColumn("run", F.col("user_id"))
        stage = F.when(F.col("event_type") == "click", "scrape").when(F.col("event_type") == "view", "normalize").when(F.col("event_type") == "purchase", "enrich").when(F.col("event_type") == "login", "sync").otherwise("notify")
        stages = events.groupBy("run", stage.alias("stage")).agg(F.count(F.lit(1)).alias("n")).select(
            "run", "stage", F.when(F.col("n") % 3 == 0, "failed").otherwise("completed").alias("status"), F.when(F.col("n") % 2 == 0, "e").alias("error"), (F.col("n") % 4).alias("skipped"), F.when(F.col("n") % 5 == 0, "r").alias("reason")
        )
        raw = t("orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("id"), "o_orderstatus")
        decisions = raw.where("id % 11 <> 0").select("run", "id", (F.col("o_orderstatus") != "F").alias("eligible"))
        quarantine = raw.where("id % 13 = 0").select("run", (F.col("id") % 2 == 0).alias("safe"))
        logs = events.where("event_id % 3 = 0").select("run", (F.col("event_type") != "error").alias("ok"))
        sent = events.select("run", (F.col("event_type") == "purchase").alias("ok"))
        return checks.strict_invariants(stages, raw, raw.where("id % 7 <> 0"), decisions, quarantine, logs, sent, sent.where("false"))

    def log_signals(spark, sf_dir):
        status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", " succeeded").otherwise("pending")
        return checks.log_signals(table(spark, sf_dir, "events").withColumn("status", status), "user_id", ["ts", "event_id"], ["event_type", "event_id"])

    def best_turns(spark, sf_dir):
        return checks.best_text(table(spark, sf_dir, "conversations"), ["conv_id"], "text", ["turn", "role"], F.col("text").rlike("[0-9]")).select("conv_id", "text")

    def enriched_ids(spark, sf_dir):
        t = lambda n: table(spark, sf_dir, n)
        parts = [t("orders").select(F.col("o_custkey").alias("id")), t("events").select(F.col("user_id").alias("id")), t("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))]
        return checks.distinct_ids(parts, "id")

    def composed_texts(spark, sf_dir):
        named = F.concat(F.lit("MAIN DUTIES\n"), F.col("p_name"), F.lit("\n\nMINIMAL S1\n"), F.initcap("p_type"))
        row = table(spark, sf_dir, "part").withColumn("named", named)
        return row.select("p_partkey", checks.combined(F.col("p_name"), F.substring_index("p_name", " ", 1)).alias("held"), checks.combined(F.col("p_brand"), F.col("p_type")).alias("joined"), checks.without_headings(F.col("named"), F.upper("p_name")).alias("lines"))

    def notification_candidates(spark, sf_dir):
        t = lambda n: table(spark, sf_dir, n)
        sent = t("events").where("event_type = 'purchase'").select(F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("run"), F.lit("events").alias("source"), F.col("user_id").alias("external_id"))
        return checks.notification_candidates(sent, t("customer").select(F.lit("events").alias("source"), F.col("c_custkey").alias("external_id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("company_name")))

    def embedded_values(spark, sf_dir):
        row = F.to_json(F.struct(F.col("o_orderkey").alias("buildId"), F.col("o_orderstatus").alias("s")))
        page = F.concat(F.lit("<html>" + embedded.PAGE_DATA), row, F.when(F.col("o_orderkey") % 5 != 0, "</script><p>x</p>").otherwise(""))
        found = table(spark, sf_dir, "orders").select("o_orderkey", embedded.script_json(page).alias("p"), embedded.first_json(F.concat(F.lit("[no] RESPONSE is {so} "), row, F.lit(" }"))).alias("first"))
        return found.select("o_orderkey", F.get_json_object("p.json", "$.buildId").alias("build_id"), "p.reason", "first")

    roles = "CASE " + " ".join(f"WHEN regexp_matches(j, '{p}') THEN '{s}'" for p, s in skills.ROLE_SKILLS.items()) + f" ELSE '{skills.ANY_SKILL}' END"
    valid = (
        f"(lower(trim(s)) NOT IN ('-', '--', 'n/a', 'na', 'none', 'null', 'unknown', 'tidak tersedia', 'not available') AND NOT regexp_matches(s, '{skills.SKILL_NUMBER}')"
        f" AND trim(lower(s), ' .') NOT IN {_IN(skills.EMPTY_SKILLS)} AND NOT (regexp_matches(trim(lower(s), ' .'), '{skills.EMPTY_STARTS}') AND length(trim(lower(s), ' .')) < 24) AND length(s) BETWEEN 2 AND 80)"
    )
    tokens = lambda c: f"regexp_extract_all(lower({c}), '[a-z0-9+#.]+')"
    ground = lambda v, s: (
        f"(len({tokens(v)}) > 0 AND (contains(array_to_string({tokens(s)}, ' '), array_to_string({tokens(v)}, ' ')) OR (len(list_filter({tokens(v)}, lambda w: length(w) >= 2)) > 0 AND "
        f"len(list_filter({tokens(v)}, lambda w: length(w) >= 2 AND NOT contains(array_to_string({tokens(s)}, ' '), w))) = 0)))"
    )
    foreign = " OR ".join(f"contains(lower(concat_ws(' ', s_name, n_name)), '{h}')" for h in wording.FOREIGN)
    return {
        "requirement_items": (requirement_items, _ITEMS + "SELECT conv_id, turn, len(items)::BIGINT AS n_items, array_to_string(items, '|') AS items FROM c5"),
        "requirement_fallbacks": (requirement_fallbacks, _ITEMS + f""", f AS (SELECT conv_id, turn, list_filter(items, lambda v: length(v) >= 60) AS w, items[1:8] AS d, ['Has core competencies relevant to the ' || role || ' role.'] AS g FROM c5),
r AS (SELECT conv_id, turn, (CASE WHEN len(w) > 0 THEN w WHEN len(d) > 0 THEN d ELSE g END)[1:{skills.RELATIONS_MOST}] AS r FROM f)
SELECT conv_id, turn, array_to_string(list_transform(r, lambda v: {_KIND}), '|') AS types, array_to_string(r, '|') AS vals FROM r"""),
        "requirement_summaries": (requirement_summaries, _ITEMS + """, e AS (SELECT *, list_transform(items[1:6], lambda x: replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS s FROM c5)
SELECT conv_id, turn, CASE WHEN len(s) > 1 THEN '<ul>' || array_to_string(list_transform(s, lambda x: '<li>' || x || '</li>'), '') || '</ul>' WHEN len(s) = 1 THEN '<p>' || s[1] || '.</p>'
  ELSE '<p>Proficient in ' || role || '.</p>' END AS html FROM e"""),
        "canonical_skills": (canonical_skills, f"WITH t AS (SELECT doc_id, coalesce({_terms('text')}, []) AS a FROM documents) SELECT doc_id, len(a)::BIGINT AS n_terms, array_to_string(a, '|') AS terms FROM t"),
        "skill_values": (skill_values, rf"""
WITH v AS (SELECT p_partkey, unnest([replace(p_type, ' ', ' and '), p_brand, replace(p_name, ' ', ' / '), 'Golang & Kubernetes']) AS x, unnest([1, 2, 3, 4]) AS i FROM part),
s AS (SELECT p_partkey, i, list_filter(list_filter(regexp_split_to_array(x, '{skills.SKILL_SPLIT}'), lambda s: s <> ''), lambda s: {valid}) || {_terms('x')} AS a FROM v),
f AS (SELECT p_partkey, flatten(list(a ORDER BY i)) AS a FROM s GROUP BY p_partkey)
SELECT p_partkey, array_to_string({_once("a")}, '|') AS found FROM f"""),
        "skill_fallbacks": (skill_fallbacks, f"""
WITH t AS (SELECT doc_id, concat_ws(' ', source, text) AS j, {_terms("concat_ws(chr(10), source, text)")} AS a FROM documents)
SELECT doc_id, CASE WHEN len(a) > 0 THEN array_to_string(a[1:8], '|') ELSE {roles} END AS found FROM t"""),
        "enrichment_rows": (enrichment_rows, _ITEMS + f""", a AS (SELECT conv_id, turn, list_transform(coalesce({_terms('text')}, []), lambda v: {{'kind': 'skill', 'type': 'SKILL', 'value': v, 'confidence': 0.6::DOUBLE}})
  || list_transform(items[1:{skills.RELATIONS_MOST}], lambda v: {{'kind': 'requirement', 'type': {_KIND}, 'value': v, 'confidence': 0.5::DOUBLE}}) AS r FROM c5),
u AS (SELECT conv_id, turn, unnest(r) AS e, generate_subscripts(r, 1) - 1 AS place FROM a) SELECT conv_id, turn, place::BIGINT AS place, e.kind AS kind, e.type AS type, e.value AS value, e.confidence AS confidence FROM u"""),
        "skill_dataset": (skill_dataset, """
SELECT l_orderkey AS listing, l_partkey AS skill, trim(p_name) AS name, regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '-', 'g') AS slug, trim(p_type) AS category,
  nullif(round_even(l_discount, 4), 0) AS confidence, upper(o_orderstatus) AS status, strftime(o_orderdate, '%Y-%m-%d') AS last_seen FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey"""),
        "unmarked_texts": (unmarked_texts, rf"""
WITH t AS (SELECT conv_id, turn, 'Persyaratan: ' || text || ' Rewritten in Indonesian. Done.' AS x FROM conversations),
s AS (SELECT *, list_filter(list_transform(regexp_split_to_array(regexp_replace(x, '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), lambda y: trim(y)), lambda y: y <> '' AND NOT regexp_matches(y, '{wording.META}')) AS a FROM t)
SELECT conv_id, turn, nullif(array_to_string(a, ' '), '') AS text, trim(regexp_replace(coalesce({_CLEAN}, ''), '{wording.PREFIX}', '')) AS bare FROM s"""),
        "grounded_values": (grounded_values, f"SELECT p_partkey, {ground('p_type', 'p_name')} AS type_in_name, {ground('string_split(p_name, chr(32))[-1]', 'p_name')} AS last_in_name FROM part"),
        "limited_summaries": (limited_summaries, """
WITH t AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS m, CASE WHEN c_custkey % 5 <> 0 THEN n_name END AS p FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey, c_name || ' at ' || coalesce(m, 'unknown company') || ' (' || coalesce(p, 'location unavailable') || '). This summary is based on source listing-level data; full details are unavailable.' AS english,
  c_name || ' di ' || coalesce(m, 'perusahaan tidak diketahui') || ' (' || coalesce(p, 'lokasi tidak tersedia') || '). Ringkasan ini dari data sumber level listing; detail penuh tidak tersedia.' AS indonesian FROM t"""),
        "home_countries": (home_countries, f"""
SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN n_name WHEN {foreign} THEN NULL ELSE 'Indonesia' END AS country, lower(s_name) || '|' || lower(n_name) AS place FROM supplier JOIN nation ON n_nationkey = s_nationkey"""),
        "source_names": (source_names, """
WITH t AS (SELECT CASE WHEN doc_id % 7 = 0 THEN 'JobStreet' ELSE upper(source[1]) || lower(source[2:]) END AS name FROM documents) SELECT name, count(*) AS n FROM t GROUP BY name"""),
        "missing_contexts": (missing_contexts, """
WITH k AS (SELECT l_orderkey AS k, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY ALL)
SELECT o_orderkey, concat_ws(',', CASE WHEN trim(coalesce(o_orderpriority, '')) = '' THEN 'title' END, CASE WHEN o_orderkey % 2 = 0 THEN 'description' END, CASE WHEN k IS NULL THEN 'requirements' END,
  CASE WHEN coalesce(r, 0) = 0 THEN 'skills' END) AS missing FROM orders LEFT JOIN k ON k = o_orderkey"""),
        "strict_run_checks": (strict_run_checks, """
WITH g AS (SELECT user_id AS run, CASE event_type WHEN 'click' THEN 'scrape' WHEN 'view' THEN 'normalize' WHEN 'purchase' THEN 'enrich' WHEN 'login' THEN 'sync' ELSE 'notify' END AS stage, count(*) AS n
  FROM events WHERE user_id IS NOT NULL GROUP BY ALL),
s AS (SELECT run, count(DISTINCT stage) AS present, sum(n % 4) FILTER (stage = 'normalize') AS skipped, count(*) FILTER (stage = 'enrich' AND n % 3 = 0) AS eb, count(*) FILTER (stage = 'sync' AND n % 3 <> 0 AND n % 5 <> 0) AS ss,
  count(*) FILTER (stage = 'notify' AND n % 3 <> 0 AND n % 5 <> 0) AS ns, count(*) FILTER (n % 3 = 0 AND n % 2 <> 0) AS ux FROM g GROUP BY run),
o AS (SELECT o_custkey AS run, count(*) AS raw, count(*) FILTER (o_orderkey % 7 <> 0) AS normal, count(*) FILTER (o_orderkey % 11 <> 0 AND o_orderstatus = 'F') AS declined, count(*) FILTER (o_orderkey % 11 = 0) AS undecided,
  count(*) FILTER (o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderstatus = 'F') AS against, count(*) FILTER (o_orderkey % 13 = 0) AS held, count(*) FILTER (o_orderkey % 13 = 0 AND o_orderkey % 2 <> 0) AS unsafe FROM orders GROUP BY ALL),
l AS (SELECT user_id AS run, count(*) FILTER (event_id % 3 = 0 AND event_type = 'error') AS fl, count(*) FILTER (event_type = 'purchase') AS sent FROM events WHERE user_id IS NOT NULL GROUP BY ALL),
r AS (SELECT run, coalesce(present, 0) AS present, coalesce(skipped, 0) AS skipped, coalesce(eb, 0) AS eb, coalesce(ss, 0) AS ss, coalesce(ns, 0) AS ns, coalesce(ux, 0) AS ux, coalesce(raw, 0) AS raw, coalesce(normal, 0) AS normal,
  coalesce(declined, 0) AS declined, coalesce(undecided, 0) AS undecided, coalesce(against, 0) AS against, coalesce(held, 0) AS held, coalesce(unsafe, 0) AS unsafe, coalesce(fl, 0) AS fl, coalesce(sent, 0) AS sent
  FROM s FULL JOIN o USING (run) FULL JOIN l USING (run)),
v AS (SELECT run, unnest(['stageRowsPresent', 'normalizeCountInvariant', 'normalizeHasEligibilityDecision', 'normalizeRespectsEligibilityDecision', 'quarantineSafeErrorEvidence', 'enrichFailureHasAiEvidence',
  'syncZeroSentHasReason', 'notifyZeroSentHasReason', 'failedStageHasErrorEvidence']) AS name,
  unnest([5 - present, (NOT (raw = normal OR held > 0 OR skipped > 0 OR declined > 0))::INT, undecided, against, unsafe, (eb > 0 AND fl = 0)::INT, (ss > 0 AND sent = 0)::INT, (ns > 0)::INT, ux])::BIGINT AS violations FROM r)
SELECT run, name, violations = 0 AS passed, violations FROM v"""),
        "log_signals": (log_signals, """
SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'purchase') AS succeeded, count(*) FILTER (event_type = 'error') AS failed, arg_max(event_type, (ts, event_id)) AS last_event_type,
  arg_max(event_id, (ts, event_id)) AS last_event_id FROM events GROUP BY user_id"""),
        "best_turns": (best_turns, "SELECT conv_id, arg_min(text, (regexp_matches(text, '[0-9]')::INT, -length(text), turn, role)) AS text FROM conversations WHERE length(text) > 0 GROUP BY conv_id"),
        "enriched_ids": (enriched_ids, "SELECT o_custkey AS id FROM orders UNION SELECT user_id FROM events WHERE user_id IS NOT NULL UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0"),
        "composed_texts": (composed_texts, """
WITH t AS (SELECT *, array_to_string(list_transform(string_split(lower(p_type), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS i FROM part)
SELECT p_partkey, p_name AS held, CASE WHEN contains(p_type, p_brand) THEN p_type WHEN contains(p_brand, p_type) THEN p_brand ELSE p_brand || chr(10) || chr(10) || p_type END AS joined,
  'MINIMAL S1' || CASE WHEN upper(i) = i THEN '' ELSE chr(10) || i END AS lines FROM t"""),
        "notification_candidates": (notification_candidates, """
SELECT strftime(ts, '%Y-%m-%d') || ':events:' || user_id AS event_id, e.event_id AS sync_event_id, 'events' AS source, user_id AS external_id, c_name AS title, c_mktsegment AS company_name
FROM events e JOIN customer ON c_custkey = user_id WHERE event_type = 'purchase'"""),
        "embedded_values": (embedded_values, """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey::VARCHAR END AS build_id, CASE WHEN o_orderkey % 5 = 0 THEN 'unterminated' END AS reason,
  '{"buildId":' || o_orderkey || ',"s":"' || o_orderstatus || '"}' AS first FROM orders"""),
    }
