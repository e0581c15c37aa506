"""Salary columns: numbers of a label, currency, period, display and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions.text import clean

NUMBER = r"(?i)(\d+(?:[.,]\d{3})*(?:[.,]\d+)?)\s*(jt|juta|m|million|rb|ribu|k)?"
#: Label words and what they mean, in the order they are tried.
PERIOD_WORDS = (
    ("monthly", ("/bulan", "per bulan", "monthly", "month")),
    ("yearly", ("/tahun", "per tahun", "yearly", "year")),
    ("daily", ("/hari", "per hari", "daily", "day")),
    ("hourly", ("/jam", "per jam", "hourly", "hour")),
)
PERIOD_VALUES = (
    ("monthly", ("month", "monthly", "bulan", "per bulan", "mo")),
    ("yearly", ("year", "yearly", "tahun", "per tahun", "yr")),
    ("daily", ("day", "daily", "hari", "per hari")),
    ("hourly", ("hour", "hourly", "jam", "per jam")),
)
LOW_BELOW, MID_BELOW = 5_000_000, 12_000_000


def _any(c: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(c, F.lit(w))
    return found


def local_number(c: Column) -> Column:
    """Decimal of a number with dots for thousands and a decimal comma; null if it is none."""
    dots = F.length(c) - F.length(F.replace(c, F.lit("."), F.lit("")))
    bare = (
        F.when(F.contains(c, F.lit(",")) & (dots > 0), F.translate(F.replace(c, F.lit("."), F.lit("")), ",", "."))
        .when(F.contains(c, F.lit(",")), F.translate(c, ",", "."))
        .when((dots > 1) | c.rlike(r"^[^.]*\.[^.]{3}$"), F.replace(c, F.lit("."), F.lit("")))
        .otherwise(c)
    )
    return bare.try_cast("decimal(38,6)")


def label_amounts(label: Column) -> Column:
    """The amounts of a label's first two numbers, with their unit or the one the label names."""
    low = F.lower(label)
    inherited = F.when(_any(low, ("jt", "juta", "million")), 1_000_000).when(_any(low, ("rb", "ribu")), 1_000).otherwise(1)
    numbers = F.slice(F.regexp_extract_all(label, F.lit(NUMBER), F.lit(1)), 1, 2)
    units = F.slice(F.regexp_extract_all(label, F.lit(NUMBER), F.lit(2)), 1, 2)

    def amount(number: Column, unit: Column) -> Column:
        u = F.lower(unit)
        times = F.when(u.isin("jt", "juta", "m", "million"), 1_000_000).when(u.isin("rb", "ribu", "k"), 1_000).otherwise(inherited)
        return (local_number(number) * times).cast("long")

    return F.filter(F.zip_with(numbers, units, amount), lambda x: x.isNotNull())


def currency_of(value: Column) -> Column:
    v = F.upper(clean(value))
    return F.when(v.isin("RP", "RUPIAH"), "IDR").when(v.isin("$", "US$", "USD"), "USD").when(v.rlike(r"^\p{L}{3}$"), v)


def label_currency(label: Column) -> Column:
    low = F.lower(label)
    return F.when(_any(low, ("rp", "idr", "rupiah")), "IDR").when(_any(low, ("usd", "$")), "USD").when(_any(low, ("sgd",)), "SGD")


def period_of(value: Column) -> Column:
    v = F.translate(F.lower(clean(value)), "_-", "  ")
    found = F.when(v.isNull(), None)
    for name, words in PERIOD_VALUES:
        found = found.when(v.isin(*words), name)
    return found.otherwise("unknown")


def label_period(label: Column) -> Column:
    low, found = F.lower(label), F.when(label.isNull(), None)
    for name, words in PERIOD_WORDS:
        found = found.when(_any(low, words), name)
    return found


def normalized(df: DataFrame, low: Column, high: Column, currency: Column, period: Column, label: Column, name: str = "salary") -> DataFrame:
    """``df`` with a salary struct: explicit values before the label's, bounds in order, null if nothing is known.

    In layers, so that each intermediate is a column and computed once, however often it is used.
    """
    df = df.withColumns({"_text": clean(label), "_low": low.cast("long"), "_high": high.cast("long"), "_money": currency_of(currency), "_term": period_of(period)})
    df = df.withColumn("_amounts", label_amounts(F.col("_text")))
    df = df.withColumns({
        "_low": F.coalesce("_low", F.get("_amounts", F.lit(0))), "_high": F.coalesce("_high", F.get("_amounts", F.lit(1))),
        "_money": F.coalesce("_money", label_currency(F.col("_text"))), "_term": F.coalesce("_term", label_period(F.col("_text"))),
    })
    swap = F.coalesce(F.col("_low") > F.col("_high"), F.lit(False))
    known = F.coalesce(F.col("_low").cast("string"), F.col("_high").cast("string"), "_money", "_term", "_text").isNotNull()
    salary = F.struct(
        F.when(swap, F.col("_high")).otherwise(F.col("_low")).alias("min_amount"), F.when(swap, F.col("_low")).otherwise(F.col("_high")).alias("max_amount"),
        F.col("_money").alias("currency"), F.col("_term").alias("period"), F.col("_text").alias("display"),
    )
    return df.withColumn(name, F.when(known, salary)).drop("_text", "_low", "_high", "_money", "_term", "_amounts")


def midpoint(low: Column, high: Column) -> Column:
    return F.when(low.isNotNull() & high.isNotNull(), F.floor((low + high) / 2)).otherwise(F.coalesce(low, high)).cast("long")


def bucket(low: Column, high: Column) -> Column:
    m = midpoint(low, high)
    return F.when(m.isNull(), "unknown").when(m < LOW_BELOW, "low").when(m < MID_BELOW, "mid").otherwise("high")


def signal(low: Column, high: Column) -> Column:
    return F.when(low.isNull() & high.isNull(), "unknown").when(low > high, "outlier").otherwise("known")


def display(low: Column, high: Column, currency: Column, period: Column) -> Column:
    """"IDR 1,000 - 2,000 / month" with what is known of it; null without amounts."""
    money = lambda x: F.format_number(x.cast("long"), 0)
    amounts = F.when(low.isNotNull() & high.isNotNull() & (low != high), F.concat(money(low), F.lit(" - "), money(high))).otherwise(money(F.coalesce(low, high)))
    suffix = F.when(period == "monthly", " / month").when(period == "yearly", " / year").when(period == "daily", " / day").when(period == "hourly", " / hour").otherwise("")
    return F.when(amounts.isNotNull(), F.concat(F.coalesce(F.concat(currency, F.lit(" ")), F.lit("")), amounts, suffix))
