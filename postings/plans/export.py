"""The whole export: five outputs from one base, held against the privacy guard before anything is published."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postings.operators.shared import materialize
from postings.plans import dataset, relations
from postings.sources.csv_sink import as_text

#: Names that no exported column may have, whole or as a part between underscores, and what no value may hold.
PRIVATE_NAMES = ("user_id", "userid", "email", "phone", "cv_text", "cv_raw_text", "resume", "personal_notes", "notes", "address")
PRIVATE_VALUES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(?:\+62|\b62|\b0)8[0-9](?:[ .-]?[0-9]){7,10}\b",
}
#: Texts of which each match of a pattern holds one: the pattern runs only over texts that do.
PARTS = {"email": ("@",), "phone": ("628", "08")}


class PrivateData(ValueError):
    """An export that would publish personal data; ``found`` has (output, column, kind, rows)."""

    def __init__(self, found: list[tuple]):
        super().__init__("private data: " + "; ".join(f"{o}.{c}: {k} in {n} rows" for o, c, k, n in found))
        self.found = found


def private_columns(columns: list[str]) -> list[str]:
    """Columns whose name is private."""
    return [c for c in columns if any(f"_{n}_" in f"_{c.lower()}_" for n in PRIVATE_NAMES)]


def private_values(df: DataFrame) -> dict[str, Column]:
    """Name "column|kind" to the number of rows whose text column holds such a value."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    may = lambda c, kind: reduce(Column.__or__, (F.contains(F.col(c), F.lit(part)) for part in PARTS[kind]))
    return {f"{c}|{kind}": F.count_if(may(c, kind) & F.col(c).rlike(pattern)) for c in texts for kind, pattern in PRIVATE_VALUES.items()}


@dataclass
class Export:
    """Outputs by name, as texts under their fixed headers, with the rows of each and the dictionary of all."""

    outputs: dict[str, DataFrame]
    counts: dict[str, int]
    dictionary: DataFrame


def frames(orders: DataFrame, customer: DataFrame, lineitem: DataFrame, part: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    """The outputs of one base: listings, requirements, skills, signals and model rows. The base is written once and read by all."""
    base = materialize(dataset.listing_base(orders, customer, lineitem, events), "export-base")
    chosen = base.select(F.col("o_orderkey"), "o_orderstatus", "o_orderdate", "o_custkey")
    # each child is joined with its listing and its entry once, for requirements and skills
    listing = chosen.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("listing_status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_seen"))
    entry = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("value"), F.col("p_brand").alias("category"), "p_type")
    child = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_discount")
    children = materialize(child.join(listing, "l_orderkey").join(entry, "l_partkey"), "export-children")
    skill = children.select(
        F.col("l_orderkey").alias("listing"), F.col("l_partkey").alias("skill"), F.col("value").alias("name"), F.col("p_type").alias("category"), F.bround("l_discount", 4).alias("confidence"),
        F.col("listing_status").alias("status"), "last_seen",
    )
    features = dataset.listing_features(base)
    ready = dataset.readiness(F.col("completeness") / 100, F.col("n_requirements") > 0, F.col("n_skills") > 0, F.col("tier") == "tier_1")
    return {
        "job_listings": features, "job_requirements": dataset.requirement_columns(children), "job_skills": relations.skill_columns(skill),
        "job_user_signals": dataset.signal_rows(chosen, events), "job_model_dataset": features.select("o_orderkey", "split", "tier", *(c.alias(f"{n}_readiness") for n, c in ready.items())),
    }


def export(made: dict[str, DataFrame]) -> Export:
    """Each output written once into the shared folder under its header, counted and looked through while it is written.

    Raises PrivateData, and publishes nothing, if a column's name is private or a value is an e-mail address or a phone number.
    An output without rows keeps its header.
    """
    found = [(name, c, "column", 0) for name, df in made.items() for c in private_columns(df.columns)]
    if found:
        raise PrivateData(found)
    outputs, counts = {}, {}
    for name, df in made.items():
        text, seen = as_text(df, df.columns), Observation()
        metrics = private_values(df)
        # observed before the cast to text, so that numbers are never read as phone numbers
        looked = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(k) for k, m in metrics.items()))
        outputs[name] = materialize(as_text(looked, text.columns), f"export-{name}")
        got = seen.get
        counts[name] = got["rows"]
        found += [(name, *k.split("|"), got[k]) for k in metrics if got[k]]
    if found:
        raise PrivateData(found)
    spark = next(iter(made.values())).sparkSession
    return Export(outputs, counts, dataset.dictionary(spark, made))


def publish(done: Export, path: str) -> None:
    """Every output as a CSV folder below ``path``, the dictionary last."""
    for name, df in done.outputs.items():
        df.write.mode("errorifexists").option("header", True).option("emptyValue", "").option("escape", '"').csv(f"{path}/{name}")
    done.dictionary.write.mode("errorifexists").option("header", True).csv(f"{path}/data_dictionary")
