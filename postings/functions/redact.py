"""Redaction and findings of secrets in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what stands in the place of a secret.
REDACTED = "<redacted>"
BEARER = r"(?i)\bBearer\s+[A-Za-z0-9._~+/=-]+"
URL_LOGIN = r"(?i)\b([A-Z0-9._%+-]+)://[^:\s/@]+:[^@\s]+@"
COOKIE = r"(?i)(^|;\s*)([^=;\s]*(?:session|token|csrf|visitor|device)[^=;\s]*)=[^;]+"
SESSION = r"(?i)\b(jobseeker(?:session|visitor)id|sessionid|visitorid|deviceid)=([a-f0-9-]{16,})"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def redact(c: Column) -> Column:
    out = F.regexp_replace(c, BEARER, f"Bearer {REDACTED}")
    out = F.regexp_replace(out, URL_LOGIN, f"$1://{REDACTED}@")
    out = F.regexp_replace(out, COOKIE, f"$1$2={REDACTED}")
    return F.regexp_replace(out, SESSION, f"$1={REDACTED}")


def findings(c: Column) -> Column:
    """(kind, count) of each kind of secret or personal data in the text."""
    low = F.lower(c)
    # a pattern runs only over texts that have what each of its matches has
    ids = F.contains(low, F.lit("sessionid=")) | F.contains(low, F.lit("visitorid=")) | F.contains(low, F.lit("deviceid="))
    kinds = {"bearer": (BEARER, F.contains(low, F.lit("bearer"))), "url_login": (URL_LOGIN, c.contains("://")), "session": (SESSION, ids), "email": (EMAIL, c.contains("@"))}
    counts = F.array(*(F.struct(F.lit(k).alias("kind"), F.when(may, F.regexp_count(c, F.lit(p))).otherwise(0).cast("long").alias("n")) for k, (p, may) in kinds.items()))
    return F.filter(counts, lambda x: x["n"] > 0)


def host_of(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))
