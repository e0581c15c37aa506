import datetime as dt

import pytest
from pyspark.sql import functions as F

from postings.functions import clean_html, dates, html, identity, json, redact, requirements, roles, salary, text


def values(spark, column, rows, schema="a string, b string, c string"):
    """The column over rows padded to three texts."""
    df = spark.createDataFrame([(*r, *[None] * (3 - len(r))) for r in rows], schema).coalesce(1)
    return [r[0] for r in df.select(column.alias("x")).collect()]


def test_cleaning(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    assert values(spark, text.clean(A), [(" a \t\n b c ",), ("  ",), (None,)]) == ["a b c", None, None]
    assert values(spark, text.is_placeholder(A), [("N/A",), (" - ",), ("x",), (None,)]) == [True, True, False, True]
    assert values(spark, text.clean_description(A), [("unknown",), (" ok  text ",)]) == [None, "ok text"]
    assert values(spark, text.without_noise(A), [("hi \U0001f600​ there★",)]) == ["hi  there"]


def test_counts_and_language(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    assert values(spark, text.paragraph_count(A), [("<p>One. Two! Three</p>",), ("",), (None,), ("a\nb",)]) == [3, 0, 0, 1]
    assert values(spark, text.token_estimate(A), [("a b",), ("",), ("a b c d e f g h i j",)]) == [3, 0, 14]
    rows = [("we work with dan yang",), ("pengalaman dengan tim",), ("team with ability",), ("xyz",), ("",)]
    assert values(spark, text.language_signal(A, F.lit("")), rows) == ["MIXED", "ID", "EN", "UNKNOWN", "UNKNOWN"]
    assert values(spark, text.looks_indonesian(A), [("dengan pengalaman",), ("with experience",)]) == [True, False]
    assert values(spark, text.keywords(A, B), [("Data Engineer, data", "SQL-Server ab")]) == [["data", "engineer", "server", "sql"]]
    assert values(spark, F.to_json(text.first_by(F.split(A, ","), F.lower)), [("A,b,a,B,c",)]) == ['["A","b","c"]']


@pytest.mark.parametrize(
    "label, low, high, money, term",
    [
        ("Rp 5 - 8 juta per bulan", 5_000_000, 8_000_000, "IDR", "monthly"),
        ("Competitive salary", None, None, None, None),
        ("5 month", 5_000_000, None, None, "monthly"),
        ("5,000", 5, None, None, None),
        ("5.000", 5000, None, None, None),
        ("USD 1.500 - 2.000 / year", 1500, 2000, "USD", "yearly"),
        ("10jt", 10_000_000, None, None, None),
        ("corporate", None, None, "IDR", None),
        ("holiday 7k", 7000, None, None, "daily"),
    ],
)
def test_salary_labels(spark, label, low, high, money, term):
    A, B, C = map(F.col, "abc")  # noqa: N806
    none = F.lit(None).cast("string")
    df = spark.createDataFrame([(label,)], "a string")
    s = salary.normalized(df, none, none, none, none, A).first().salary
    assert (s.min_amount, s.max_amount, s.currency, s.period, s.display) == (low, high, money, term, label)


def test_salary_values(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    none = F.lit(None).cast("string")
    df = spark.createDataFrame([(None, None, None), ("8000000", "5000000", None)], "a string, b string, c string").coalesce(1)
    assert salary.normalized(df, A, B, none, none, C).first().salary is None
    s = salary.normalized(df, A, B, F.lit("rupiah"), F.lit("per-bulan"), C).collect()[1].salary
    assert tuple(s) == (5_000_000, 8_000_000, "IDR", "monthly", None)
    long = lambda c: c.cast("long")
    rows = [("4000000", "5000000"), ("6000000",), (None, "20000000"), (None,)]
    assert values(spark, salary.bucket(long(A), long(B)), rows) == ["low", "mid", "high", "unknown"]
    assert values(spark, salary.signal(long(A), long(B)), [("2", "1"), (None,), ("1", "2")]) == ["outlier", "unknown", "known"]
    assert values(spark, salary.display(long(A), long(B), C, F.lit("monthly")), [("1000", "2000", "IDR"), ("5", "5", None), (None,)]) == ["IDR 1,000 - 2,000 / month", "5 / month", None]


def test_dates(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    rows = [("2026-05-01T17:30:00+07:00",), ("2026-05-01",), ("not a date",), ("2026-05",), ("3 hari yang lalu",), ("2026-05-01T10:30:00Z",)]
    utc = lambda *x: dt.datetime(*x)
    assert values(spark, dates.absolute(A).cast("string"), rows) == ["2026-05-01 10:30:00", "2026-05-01 00:00:00", None, None, None, "2026-05-01 10:30:00"]
    assert values(spark, dates.posted_label(A, B), [("3 hari yang lalu",), ("2026-05-01", "label"), ("just now",)]) == ["3 hari yang lalu", "label", "just now"]
    assert len(set(values(spark, dates.epoch(A).cast("string"), [("1700000000",), ("1700000000000",), ("1700000000000000",)]))) == 1
    stamp = F.lit(utc(2024, 1, 2, 3, 4, 5)).cast("timestamp")
    assert values(spark, dates.iso_z(stamp), [(None,)]) == ["2024-01-02T03:04:05Z"]
    assert values(spark, dates.iso_z(F.timestamp_micros(F.lit(1_500_000))), [(None,)]) == ["1970-01-01T00:00:01.500000Z"]
    assert values(spark, dates.day_run_id("sync", F.timestamp_seconds(F.lit(72_000)), "Asia/Jakarta"), [(None,)]) == ["sync-19700102"]


def test_roles(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    assert values(spark, roles.role_family(A), [("Maintenance",), ("Backend dev",), ("UI artist",), ("Sales",), ("Cook",)]) == ["data_ai", "engineering", "design", "growth", "other"]
    rows = [("Team Lead",), ("senior dev",), ("3 - 5 years",), ("6+ years",), ("1 year",), ("3 t 5",), ("International",), ("cook",)]
    assert values(spark, roles.infer_level(roles.level_text(A)), rows) == ["lead", "senior", "mid_level", "senior", "entry_level", "mid_level", "entry_level", "entry_level"]
    assert values(spark, roles.seniority_number(A), [("JUNIOR",), ("LEAD",), ("x",), (None,)]) == [2, 5, 0, 0]
    assert values(spark, roles.work_type(A), [("Work From Home",), ("on-site",), ("Hybrid",), (None,)]) == ["remote", "onsite", "hybrid", "unknown"]
    assert values(spark, roles.employment_type(A), [("FullTime",), ("Contract work",), ("internship",), ("x",)]) == ["full_time", "contract", "internship", "unknown"]
    none, home = F.lit(None).cast("string"), F.lit(True)
    assert tuple(values(spark, roles.location(none, none, none, A, F.lit(None).cast("boolean")), [("Bandung, West Java",)])[0]) == ("Bandung", "West Java", None, "Bandung, West Java")
    assert tuple(values(spark, roles.location(none, none, A, none, home), [("Indonesia",)])[0]) == ("Remote", "Indonesia", "Indonesia", "Remote, Indonesia, Indonesia")


def test_requirements(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    rows = [("Menguasai Python",), ("S1 degree",), ("5 years experience",), ("managing teams",), ("be kind",), ("we use C++ daily",)]
    assert values(spark, requirements.requirement_class(A), rows) == ["SKILL", "EDUCATION", "EXPERIENCE", "RESPONSIBILITY", "OTHER", "OTHER"]
    assert values(spark, requirements.is_noise(A), [("bonus and BPJS",), ("python",)]) == [True, False]
    assert values(spark, requirements.split_items(A), [("One two. Three; four\n- five\nONE TWO.",)]) == [["One two.", "Three;", "four", "five"]]
    assert values(spark, requirements.tech_terms(A), [("Python and SQL, python, Node.js",)]) == [["python", "sql", "node.js"]]


def test_html_and_redaction(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    assert values(spark, html.to_text(A), [("<p>Hi <b>you</b></p><script>x()</script><!-- c --> a&amp;b",)]) == ["Hi you a&b"]
    assert values(spark, html.is_safe(A), [("<p>x</p>",), ('<p class="a">x</p>',), ("<div>x</div>",), ("javascript: x",)]) == [True, False, False, False]
    assert values(spark, html.display(A), [("- a\n- b<c",), ("one\ntwo",), ("",)]) == ["<ul><li>a</li><li>b&lt;c</li></ul>", "<p>one two</p>", None]
    rows = [("Bearer abc.def-1",), ("postgresql://u:p@host/db",), ("a=1; mysession=zz; b=2",), ("sessionid=0123456789abcdef0",)]
    out = values(spark, redact.redact(A), rows)
    assert out == ["Bearer <redacted>", "postgresql://<redacted>@host/db", "a=1; mysession=<redacted>; b=2", "sessionid=<redacted>"]
    assert [len(x) for x in values(spark, redact.findings(A), rows)] == [1, 1, 0, 1]


def test_identity(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    assert values(spark, identity.identity_key(A, B), [(" Src ", "ID1"), ("", "x"), (None, "x")]) == ["src:id1", None, None]
    none = F.lit(None).cast("string")
    assert values(spark, identity.fingerprint(A, B, none, none, none), [("s",), (None, "x"), ("s", "x")])[:2] == [None, None]
    assert set(values(spark, identity.split_of(A), [(str(i),) for i in range(300)])) == {"train", "validation", "test"}


def test_parsed_html(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    rows = [('<p onclick="x">Hi <b>there</b><script>bad()</script> &lt;you&gt;<ul><li>one</ul> 5 < 6',), (None,), ("",), ("</p></ul>x<br/>",)]
    assert values(spark, clean_html.sanitise(A), rows) == ["<p>Hi there &lt;you&gt;<ul><li>one</li></ul> 5 &lt; 6</p>", None, "", "x<br>"]
    assert values(spark, clean_html.full_text(A), rows) == ["Hi there <you> one 5 < 6", None, "", "x"]


def test_json(spark):
    A, B, C = map(F.col, "abc")  # noqa: N806
    rows = [('{"b": [1, 2, 3], "a": {"token": "x", "jobId": 7}}',), ("no json",), (None,), ('["x", {"trace": {"jobId": 1}}]',)]
    assert values(spark, json.canonical_text(A), rows) == ['{"a":{"jobId":7,"token":"x"},"b":[1,2,3]}', None, None, '["x",{"trace":{"jobId":1}}]']
    assert values(spark, json.find_key(A, ("jobId",)), rows) == ["7", None, None, None]
    assert values(spark, json.shrink(A, 2), rows)[0] == '{"a":{"jobId":7,"token":"x"},"b":[1,2]}'
    assert values(spark, json.redact_keys(A), rows)[0] == '{"a":{"jobId":7,"token":"<redacted>"},"b":[1,2,3]}'
    assert values(spark, json.has_text_under(A, ("token",)), rows) == [True, None, None, False]
    assert values(spark, json.gap_count(A), [("[1,2]",), ('{"gaps":[1]}',), ('{"x":1,"y":2}',), ("text",), ("",), (None,)]) == [2, 1, 2, 1, 0, 0]
    assert values(spark, json.canonical_struct({"z": A, "a": B}), [("x", None)]) == ['{"a":null,"z":"x"}']


def test_a_part_that_is_used_many_times_stands_in_the_plan_once(spark):
    from postings.functions import html, skills, text

    df = spark.range(1).selectExpr("CAST(id AS string) AS x")
    count = lambda c: df.select(c.alias("c"))._jdf.queryExecution().optimizedPlan().toString().count("MARK")
    marked = F.regexp_replace("x", "MARK", "")
    assert count(text.first_by(F.split("x", "MARK"), F.lower)) == 1
    assert count(html.display(marked)) == 1
    assert count(skills.summary(F.split("x", "MARK"), F.array(F.lit("SQL")))) == 1
    assert count(skills.is_low_signal(marked)) <= 3


def test_pages_are_worked_on_in_slices():
    import pyarrow as pa

    from postings.functions import clean_html

    pages = [None if i % 7 == 0 else f"<p>{i}</p>" for i in range(2 * clean_html.SLICE + 1)]
    got = list(clean_html._slices(iter([pa.array(pages, pa.string()), pa.array([], pa.string())]), str.upper))
    assert [len(x) for x in got] == [clean_html.SLICE, clean_html.SLICE, 1]
    assert [t for x in got for t in x.to_pylist()] == [None if t is None else t.upper() for t in pages]
