import json

from pyspark.sql import functions as F

from postings.operators.validate import canonical_rules, quarantine_rows, resolve_quarantine, split_valid
from postings.sources.mappers import map_source

A = {"id": "1", "slug": "dev", "role": " Backend  Dev ", "company": {"name": "Acme"}, "city": {"name": "Bandung"}, "country": {"name": "Indonesia"}, "salaryRange": {"start": 9, "end": 5}, "employmentTypes": ["fullTime"],
     "workplaceType": "remote", "experienceLevel": "junior", "publishedAt": "2026-05-01T17:30:00+07:00", "status": "active", "skills": [{"name": "SQL"}, {"name": " Go "}, {"name": "SQL"}, {}], "detail": {"description": "<p>Hello</p><script>x</script>"}}
C = {"id": "2", "title": "List title", "companyName": "Beta", "locations": [{"label": "Jakarta, DKI"}], "salaryLabel": "Rp 5 - 8 juta per bulan", "workTypes": ["Contract"], "listingDate": {"label": "3 days ago"}, "detail": {"job": {"title": "Detail title"}}}
E = {"id": "3", "positionName": "Senior cook", "company": {"name": "Gamma"}, "salaryLowerBound": 0, "salaryUpperBound": 7, "isClosed": True}


def mapped(spark, source, payload):
    rows = spark.createDataFrame([(source, payload.get("id"), json.dumps(payload))], "source string, external_id string, payload string").withColumn("scraped_at", F.lit("2026-05-02").cast("timestamp"))
    return map_source(rows, source)


def test_mapping(spark):
    a = mapped(spark, "source_a", A).first()
    assert (a.title, a.company, a.work_type, a.employment_type, a.experience_level, a.status, a.skills, a.description) == ("Backend Dev", "Acme", "remote", "full_time", "junior", "active", ["SQL", "Go"], "Hello")
    assert tuple(a.salary)[:2] == (5, 9) and tuple(a.location) == ("Bandung", "Indonesia", "Indonesia", "Bandung, Indonesia, Indonesia") and a.posted_at.hour == 10
    c = mapped(spark, "source_c", C).first()
    assert (c.title, c.employment_type, c.status, c.posted_at, c.posted_label) == ("Detail title", "contract", "active", None, "3 days ago")
    assert tuple(c.salary) == (5_000_000, 8_000_000, "IDR", "monthly", C["salaryLabel"]) and c.location.region == "DKI" and c.provenance["title"] == "$.detail.job.title"
    e = mapped(spark, "source_e", E).first()
    assert (e.salary.min_amount, e.salary.max_amount, e.status, e.experience_level, e.skills) == (None, 7, "inactive", "senior", [])


def test_validation_and_quarantine(spark):
    df = mapped(spark, "source_a", A).unionByName(mapped(spark, "source_a", {"id": "9", "role": "x" * 300, "salaryRange": {"start": -1, "end": 4}}))
    good, bad = split_valid(df, canonical_rules())
    assert [r.external_id for r in good.collect()] == ["1"]
    assert bad.first().violations == ["missing_company", "negative_amount", "title_too_long"]
    at = F.lit("2026-05-02").cast("timestamp")
    q = quarantine_rows(bad, ["source", "external_id"], at)
    assert tuple(q.first())[:5] == ("source_a", "9", "validation", "missing_company; negative_amount; title_too_long", "company")
    assert {r.status for r in resolve_quarantine(q, bad, "external_id", at).collect()} == {"resolved"}
    assert {r.status for r in resolve_quarantine(q, good, "external_id", at).collect()} == {"open"}
