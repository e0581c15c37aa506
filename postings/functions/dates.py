"""Date columns: absolute instants, relative labels, epochs and formatting, in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions.text import clean

RELATIVE = (
    r"(?i)\b(\d+\s+)?(detik|menit|jam|hari|minggu|bulan|tahun|seconds?|minutes?|hours?|days?|weeks?|months?|years?)\s+(yang\s+lalu|ago)\b"
)
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def is_relative(c: Column) -> Column:
    return c.rlike(RELATIVE) | F.lower(c).isin("baru saja", "just now", "today", "yesterday")


def absolute(c: Column) -> Column:
    """Instant of an ISO date or date-time (a date alone is its midnight); null for labels and partial dates."""
    text = clean(c)
    return F.when(text.rlike(ISO) & ~is_relative(text), F.try_to_timestamp(text))


def posted_label(value: Column, label: Column) -> Column:
    text = clean(value)
    return F.coalesce(clean(label), F.when(is_relative(text), text))


def epoch(c: Column) -> Column:
    """Instant of a number of seconds, milliseconds or microseconds, told by magnitude."""
    n = c.cast("long")
    return F.when(n >= 10**15, F.timestamp_micros(n)).when(n >= 10**12, F.timestamp_millis(n)).otherwise(F.timestamp_seconds(n))


def iso_z(c: Column) -> Column:
    """ISO text with Z; a fraction only where it isn't zero."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(c), F.lit(1_000_000))
    return F.concat(whole, F.when(micros > 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(""), F.lit("Z"))


def duration_ms(start: Column, end: Column) -> Column:
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1000)


def day_run_id(stage: str, at: Column, zone: str) -> Column:
    return F.concat(F.lit(f"{stage}-"), F.date_format(F.from_utc_timestamp(at, zone), "yyyyMMdd"))
