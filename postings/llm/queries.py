"""The opN queries and their SQL: thin digests over the operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.llm.chat import rotate
from postings.llm.decontaminate import flag_contaminated
from postings.llm.language import fit as fit_language
from postings.llm.language import languages
from postings.llm.line_dedup import dedup_lines
from postings.llm.mixing import mix
from postings.llm.near_dedup import near_duplicates
from postings.llm.passages import drop_repeats
from postings.llm.prefix_trie import prefix_trie
from postings.llm.quality_classifier import fit, quality_scores
from postings.llm.quality_rules import quality_rules
from postings.llm.search import search
from postings.llm.token_files import token_files
from postings.llm.toxicity import fit as fit_toxicity
from postings.llm.toxicity import toxicity_scores

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


OP1_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), e AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node
), c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""



def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeats(table(spark, sf_dir, "documents"), k=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT win.doc_id, i + o AS p FROM win JOIN least USING (s), range(0, 13) AS r(o) WHERE m < win.doc_id
), words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("failed_rule")


OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (SELECT doc_id, s FROM win GROUP BY doc_id, s HAVING count(*) > 1
), rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM win JOIN twice USING (doc_id, s), range(0, 3) AS r(o) GROUP BY doc_id
), b AS (
  SELECT w.doc_id, text, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 5 * n_lines
    OR 100 * n_repeat_words > 30 * n_words OR length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > 0.4 * word_chars
    OR 5 * (length(text) - length(replace(text, '!', ''))) > n_words OR 10 * length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 7 * word_chars) AS kept
FROM f
"""

def op5_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["stop"].cast("string"))), ",")
    return rotate(table(spark, sf_dir, "conversations")).withColumn("mask", spans)


OP5_SQL = """
WITH r AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS body FROM conversations
), t AS (
  SELECT r.*, perspective, CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>'
    ELSE '<|user name=' || speaker || '|>' END || chr(10) AS head
  FROM r JOIN (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM r WHERE speaker <> 'system') ON c = conv_id
), p AS (
  SELECT *, head || body || '<|end|>' || chr(10) AS piece,
    sum(length(head) + length(body) + 8) OVER (PARTITION BY conv_id, perspective ORDER BY turn, speaker, body ROWS UNBOUNDED PRECEDING) - (length(head) + length(body) + 8) AS start
  FROM t
), s AS (SELECT *, start // 32768 AS segment, start - min(start) OVER (PARTITION BY conv_id, perspective, start // 32768) AS off FROM p)
SELECT conv_id, perspective, segment::BIGINT AS segment, arg_min(turn, start) AS first_turn, count(*) AS n_turns, string_agg(piece, '' ORDER BY start) AS text,
  coalesce(string_agg((off + length(head))::BIGINT || '-' || (off + length(piece) - 1)::BIGINT, ',' ORDER BY start) FILTER (speaker = perspective), '') AS mask
FROM s GROUP BY ALL
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit(docs, table(spark, sf_dir, "labels"), "quality"))


def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH n AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.7) AS w FROM documents GROUP BY source
), r AS (SELECT source, w / (SELECT sum(w) FROM n) * (SELECT sum(n) FROM n) / n AS rate FROM n
), c AS (
  SELECT source, k, sum(exp(-rate) * pow(rate, k) / gamma(k + 1)) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS cdf
  FROM r, range(0, 200) AS g(k) WHERE k <= rate + 12 * sqrt(rate) + 20
), u AS (SELECT *, ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM documents
), d AS (SELECT u.* EXCLUDE (u), (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND cdf <= u.u) AS copies FROM u)
SELECT * EXCLUDE (copies), md5('mix-1:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || mix_copy) AS mix_key
FROM (SELECT *, unnest(range(1, copies + 1))::INT AS mix_copy FROM d WHERE copies > 0)
"""



def op11_blockmax_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = rf"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), d AS (SELECT doc_id, ts, len(ts) AS n FROM t WHERE len(ts) > 0
), total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), p AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, total GROUP BY term, docs
), s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), total GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 50
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS tok FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT c, list(tok ORDER BY pos) AS own,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295::BIGINT) % 4 AS h
  FROM t GROUP BY c
), r AS (
  SELECT o.c, list_concat(coalesce(b.own[1:o.h], []), o.own[o.h + 1:]) AS seq FROM o LEFT JOIN o b ON b.c = o.c - o.c % 20
), p AS (
  SELECT c, d, md5(seq[1:d]::JSON::VARCHAR) AS k, len(seq) AS n, CASE WHEN d = 0 THEN '' ELSE seq[d].text END AS last FROM r, range(0, 100000) AS g(d) WHERE d <= len(seq)
), node AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, any_value(last) AS last, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends FROM p GROUP BY k, d
), spot AS (SELECT p.c, p.d, node.conv_id FROM p JOIN node USING (k, d)
), up AS (SELECT node.*, spot.conv_id AS parent_conv_id FROM node LEFT JOIN spot ON spot.c = node.conv_id AND spot.d = node.d - 1
), kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM up WHERE d > 0 GROUP BY ALL
), own AS (
  SELECT up.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * len(regexp_extract_all(last, '[^\x20\x09-\x0D]+')) AS saved FROM up LEFT JOIN kids USING (conv_id, d)
), total AS (
  SELECT spot.conv_id, spot.d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM own JOIN spot ON spot.c = own.conv_id AND spot.d <= own.d GROUP BY ALL
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256 FROM own JOIN total USING (conv_id, d)
"""


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return languages(docs, fit_language(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_token_files": op2_token_files,
    "op3_line_dedup": op3_line_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_chat_perspectives": op5_chat_perspectives,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_poisson_mixing": op10_poisson_mixing,
    "op11_blockmax_search": op11_blockmax_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_language_id": op13_language_id,
}
ORACLES: dict[str, str] = {
    "op1_minhash_dedup": OP1_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op5_chat_perspectives": OP5_SQL,
    "op8_quality_rules": OP8_SQL,
    "op10_poisson_mixing": OP10_SQL,
    "op11_blockmax_search": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
}
