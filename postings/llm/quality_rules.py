"""Quality rules as a short-circuit cascade, on Column expressions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.common import SPACE_CLASS, WORD_CLASS

#: Documents of the sample.
SAMPLE_DOCS = 1000
#: How many plain passes over a text a pattern costs (measured: 0.13 against 0.03 seconds).
PATTERN_COST = 4
#: A word's place takes the low 20 bits of a window's sort key; longer texts use whole structs instead.
PLACE_BITS = 20


@dataclass(frozen=True)
class Rule:
    """A text fails if ``fails`` holds; it may use the base columns and ``text``."""

    name: str
    fails: str


#: Bounds of published web-corpus filters (mean word length, symbols, repeated lines and words), and shouting.
RULES = (
    Rule("mean_word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("symbol_words", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 5 * n_lines"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("shouting", "length(regexp_replace(text, '[^\\\\p{Lu}]', '')) > 0.4 * word_chars"),
    Rule("exclamation", "5 * (length(text) - length(replace(text, '!', ''))) > n_words"),
    Rule("few_letters", "10 * length(regexp_replace(text, '[^\\\\p{L}]', '')) < 7 * word_chars"),
)


def _covered(places: Column) -> Column:
    """Words covered by 3-word windows that begin at these ascending places."""
    n = F.size(places)
    gaps = F.zip_with(F.slice(places, 2, F.greatest(n - 1, F.lit(0))), F.slice(places, 1, F.greatest(n - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(3).cast("long")))
    return F.when(n > 0, F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g) + 3).otherwise(F.lit(0).cast("long"))


def with_base(df: DataFrame, text: Column, id_col: Column) -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of each row.

    Repeated windows are found inside the row: every 3-word window gives a 64-bit sort key of
    44 hash bits and its place, the primitive array is sorted, and neighbours of equal hash
    count if their words are equal too. No row leaves its task and nothing is shuffled.
    """
    df = df.select(id_col.alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    words = F.filter(F.split("text", SPACE_CLASS + "+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CLASS))
    df = df.select("doc_id", "text", words.alias("words"), lines.alias("lines"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    df = df.select("*", F.size("words").cast("long").alias("n_words"), hashes.alias("hashes"))
    low = 2**PLACE_BITS - 1
    # windows of places 0 .. n - 3; longer texts than the key has places for keep (hash, place) structs
    triple = lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2))
    starts = F.slice("hashes", 1, F.greatest(F.size("hashes") - 2, F.lit(0)))
    key = F.transform(starts, lambda h, i: triple(h, i).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
    wide = F.transform(starts, lambda h, i: F.struct(triple(h, i).alias("h"), i.cast("long").alias("i")))
    short = F.col("n_words") <= low
    df = df.select(
        "*",
        F.when(short, F.sort_array(key)).alias("sorted"),
        F.when(~short, F.sort_array(wide)).alias("wide"),
    )
    # places of windows that equal a neighbour in sorted order
    word = lambda i: F.get("words", i.cast("int"))
    same = lambda i, j: (word(i) == word(j)) & (word(i + 1) == word(j + 1)) & (word(i + 2) == word(j + 2))
    n = F.size("sorted")
    near = F.zip_with(
        F.slice("sorted", 1, F.greatest(n - 1, F.lit(0))),
        F.slice("sorted", 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.when(
            (F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)) & same(a.bitwiseAND(F.lit(low)), b.bitwiseAND(F.lit(low))),
            F.array(a.bitwiseAND(F.lit(low)), b.bitwiseAND(F.lit(low))),
        ),
    )
    m = F.size("wide")
    near_wide = F.zip_with(
        F.slice("wide", 1, F.greatest(m - 1, F.lit(0))),
        F.slice("wide", 2, F.greatest(m - 1, F.lit(0))),
        lambda a, b: F.when((a["h"] == b["h"]) & same(a["i"], b["i"]), F.array(a["i"], b["i"])),
    )
    pairs = F.filter(F.when(short, near).otherwise(near_wide), lambda x: x.isNotNull())
    df = df.select("doc_id", "text", "words", "lines", "n_words", F.sort_array(F.array_distinct(F.flatten(pairs))).alias("places"))
    bare = F.translate("text", " \t\n\x0b\f\r", "")
    return df.select(
        "doc_id",
        "text",
        "n_words",
        F.length(bare).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("places")), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def cascade_order(sample: DataFrame, rules: tuple[Rule, ...]) -> list[Rule]:
    """Rules by rejected share per cost on the sample, best first (ties by name).

    Both come from one pass over the sample. A rule's cost is the mean number of characters it
    goes over in a row, PATTERN_COST times as many for a pattern, and 1 for its counts. Times
    of runs were tried: between rules they differ less than from run to run, so the same sample gave several orders.
    """
    hits = [F.count_if(F.expr(r.fails)).alias(f"hits_{i}") for i, r in enumerate(rules)]
    found = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg(F.length("text")), F.lit(0.0)).alias("chars"), *hits).first()

    def gain(i: int) -> float:
        scans = len(re.findall(r"\btext\b", rules[i].fails)) + (PATTERN_COST - 1) * len(re.findall(r"\b(?:regexp_\w+|rlike)\b", rules[i].fails))
        return found[f"hits_{i}"] / max(1, found["n"]) / (1 + scans * found["chars"])

    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-gain(i), rules[i].name))]


def quality_rules(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Each row's base counts, ``base_failed``, ``kept`` and ``failed_rule`` (the first that rejected it).

    The order of the cascade comes from about ``sample_docs`` rows drawn from all; it decides which rules are
    evaluated and which is named, never the verdict, which is that no rule rejects. Null text
    counts as empty (it fails the base rule); rows with null or repeated ids are judged like
    others; an empty table gives an empty result.
    """
    source = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    # a sample of all rows, not the first ones; counting reads no text
    drawn = df.sample(min(1.0, sample_docs / max(1, df.count())), seed=11)
    sample = with_base(drawn, *source).cache()
    order = cascade_order(sample, rules)
    sample.unpersist()
    base = with_base(df, *source).withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in order:  # CASE stops at the first branch that holds
        verdict = verdict.when(F.expr(rule.fails), F.lit(rule.name))
    judged = base.withColumn("failed_rule", verdict)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")
