"""Mixing sources to target weights by Poisson replication, on Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.common import materialize

#: Without explicit weights, sources weigh as their size to this power (as multilingual corpora are often flattened).
TEMPERATURE, SEED = 0.7, "mix-1"
#: A rate above this is drawn as the sum of equal parts (exp(-rate) would leave the doubles), copies are made so many at a time.
MOST_RATE, AT_ONCE = 500.0, 4096


def unit(*parts: Column | str) -> Column:
    """A uniform number in [0, 1) from 52 bits of the md5 of the parts joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / float(2**52)


def source_rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate, parts, cdf): mean repetitions that bring each source to its weight, all rows kept in number.

    ``weights`` has (source, weight); a source without one weighs 0. A source's mean is
    ``parts`` times ``rate``; ``cdf`` is the Poisson distribution of ``rate`` up to where
    doubles reach 1.
    """
    # two steps, so that a source with a third of all rows is counted by many tasks
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        given = weights.groupBy(F.col("source").alias("given")).agg(F.sum(F.col("weight").cast("double")).alias("weight"))
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("given")), "left").select("source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sizes = materialize(sizes, "sizes")
    total = sizes.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights"))
    rated = sizes.crossJoin(total).withColumn("rate", F.when(F.col("weights") > 0, F.col("weight") / F.col("weights") * F.col("rows") / F.col("n")).otherwise(0.0))
    # a sum of Poisson numbers is one of the summed rate
    rated = rated.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST_RATE)).cast("long")).withColumn("rate", F.col("rate") / F.col("parts"))
    last = (F.col("rate") + 12 * F.sqrt("rate") + 20).cast("int")
    start = F.struct(F.exp(-F.col("rate")).alias("p"), F.array(F.exp(-F.col("rate"))).alias("cdf"))
    step = lambda s, k: F.struct((s["p"] * F.col("rate") / k).alias("p"), F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * F.col("rate") / k)).alias("cdf"))
    return rated.select("source", "rate", "parts", F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["cdf"]).alias("cdf"))


def mix(df: DataFrame, *, weights: DataFrame | None = None, temperature: float = TEMPERATURE, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The rows of ``df``, each as often as its Poisson draw says, in a global random order, with ``mix_copy`` and ``mix_key``.

    The draw inverts the Poisson distribution of the source's rate (small tables of rates, that
    Spark broadcasts only under its threshold) at a number made from seed and id: it needs no
    state and is the same in every retry and for any partitioning. Rows of one id are drawn
    together. The shuffle deals copies out by a hash of seed, id and copy and sorts each
    partition by it. A null source is a source; rows of null ids are drawn as id "null". An
    empty table gives an empty result. Columns of ``df`` keep their names and values, but ones
    named ``mix_copy`` or ``mix_key`` are replaced. No rate is too high: beyond MOST_RATE the
    draw is a sum of draws, and copies are made in bounded arrays.
    """
    own = "mix"
    while any(c.lower().startswith(f"{own}_") and c not in ("mix_copy", "mix_key") for c in df.columns):
        own += "x"  # working columns that no column of the input can clash with
    source, key, given, cdf, parts, u, n, some = (f"{own}_{x}" for x in ("source", "id", "given", "cdf", "parts", "u", "n", "some"))
    kept = [c for c in df.columns if c not in ("mix_copy", "mix_key")]
    docs = df.select(*kept, F.col(source_col).alias(source), F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias(key))
    rates = materialize(source_rates(docs.select(F.col(source).alias("source")), weights, temperature), "rates")
    rates = rates.select(F.col("source").alias(given), F.col("cdf").alias(cdf), F.col("parts").alias(parts))
    draw = docs.join(rates, F.col(source).eqNullSafe(F.col(given))).withColumn(u, unit(F.lit(seed), F.col(key)))
    # copies 1..n while the cumulative probability of n - 1 is at most u
    drawn = lambda at: F.size(F.filter(cdf, lambda c: c <= at)).cast("long")
    more = F.aggregate(F.sequence(F.lit(2).cast("long"), parts), F.lit(0).cast("long"), lambda s, j: s + drawn(unit(F.lit(seed), F.col(key), j.cast("string"))))
    draw = draw.withColumn(n, drawn(F.col(u)) + F.when(F.col(parts) > 1, more).otherwise(0)).where(F.col(n) > 0)
    copies = draw.withColumn(some, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / AT_ONCE))))
    first = F.col(some) * AT_ONCE
    copies = copies.withColumn("mix_copy", F.explode(F.sequence((first + 1).cast("int"), F.least(F.col(n), first + AT_ONCE).cast("int"))))
    keyed = copies.withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), key, F.col("mix_copy").cast("string"))))
    dealt = keyed.select(*kept, "mix_copy", "mix_key").repartition("mix_key")
    return dealt.sortWithinPartitions("mix_key")
