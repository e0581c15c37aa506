"""Fixed-header CSV folders: null as empty, booleans as 1 and 0, instants as ISO text with Z."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.functions.dates import iso_z


def as_text(df: DataFrame, header: list[str]) -> DataFrame:
    """The header's columns as texts."""
    kinds, out = dict(df.dtypes), []
    for c in header:
        x = F.col(c)
        if c not in kinds:
            x = F.lit("")
        elif kinds[c] == "boolean":
            x = x.cast("int").cast("string")
        elif kinds[c] == "timestamp":
            x = iso_z(x)
        elif kinds[c].startswith(("array", "map", "struct")):
            x = F.to_json(x)
        else:
            x = x.cast("string")
        out.append(F.coalesce(x, F.lit("")).alias(c))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, header: list[str]) -> None:
    """A folder of UTF-8 CSV parts; an empty table keeps its header."""
    as_text(df, header).write.mode("errorifexists").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def guard_width(df: DataFrame, columns: list[str], most: int, key: str) -> DataFrame:
    """``df``, failing when it is read if a row's columns are together longer than ``most``; the message names the row."""
    size = F.lit(0)
    for c in columns:
        size = size + F.length(F.coalesce(F.col(c).cast("string"), F.lit("")))
    message = F.concat(F.lit("row too wide: "), F.col(key).cast("string"))
    return df.withColumn(key, F.when(size > most, F.raise_error(message).cast(dict(df.dtypes)[key])).otherwise(F.col(key)))
