from pyspark.sql import functions as F

from postings.functions import skills, wording


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_skills(spark):
    values = F.array(*map(F.lit, ("Python / SQL and golang", " - ", "soft skills", "abc_123", "x", "Kemampuan kerja")), F.lit(None).cast("string"))
    found, terms, none = one(spark, skills.sanitised_skills(values), skills.canonical_terms(F.lit("react.js, NODE.js, golang, Go")), skills.canonical_terms(F.lit(None).cast("string")))
    assert found == ["Python", "SQL", "golang", "Go"] and terms == ["React", "Node.js", "Go"] and none == []
    null = F.lit(None).cast("string")
    role, term, any_ = one(spark, skills.fallback_skills(F.lit("Tax Auditor"), null, null), skills.fallback_skills(F.lit("Tax Auditor"), F.lit("AWS"), null), skills.fallback_skills(null, null, null))
    assert (role, term, any_) == (["Financial Analysis"], ["AWS"], ["Effective Communication"])
    assert one(spark, skills.first_filled(F.array().cast("array<string>"), F.array(F.lit("a")))) == (["a"],)


def test_requirement_items(spark):
    text = "<p>Kualifikasi: minimal S1 jurusan apa saja. - Menguasai bahasa asing aktif; BPJS dan bonus tahunan;\n* Python\nok\nmenguasai bahasa asing aktif.</p>"
    comma = ", ".join(f"mampu bekerja dalam tim nomor {i}" for i in range(5))
    got, long, empty = one(spark, skills.items(F.lit(text)), skills.items(F.lit(comma)), skills.items(F.lit("")))
    assert got == ["minimal S1 jurusan apa saja", "Menguasai bahasa asing aktif;", "Python", "menguasai bahasa asing aktif"]
    assert len(long) == 5 and empty == []
    sentence = skills.fallback_requirements(F.lit("Cook"), skills.items(F.lit("")), skills.items(F.lit("ok")))
    html, listed, spoken, none = one(
        spark, skills.summary(F.array(F.lit("a b c")), F.array().cast("array<string>")), skills.summary(F.array(F.lit("a"), F.lit("b")), F.array().cast("array<string>")),
        skills.summary(F.array().cast("array<string>"), F.array(F.lit("Go"), F.lit("SQL"))), skills.summary(F.array().cast("array<string>"), F.array().cast("array<string>")),
    )
    assert [tuple(r) for r in one(spark, sentence)[0]] == [("OTHER", "Has core competencies relevant to the Cook role.")]
    assert (html, listed, spoken, none) == ("<p>a b c.</p>", "<ul><li>a</li><li>b</li></ul>", "<p>Proficient in Go, SQL.</p>", None)


def test_wording(spark):
    null = F.lit(None).cast("string")
    assert one(spark, wording.without_meta(F.lit("One. Deskripsi ini disusun ulang oleh kami! Two")), wording.without_meta(F.lit("Rewritten in Indonesian.")), wording.without_prefix(null)) == ("One. Two", None, "")
    assert one(spark, wording.grounded(F.lit("C++ API"), F.lit("an api for c++")), wording.grounded(F.lit("x y"), F.lit("z")), wording.grounded(F.lit(""), F.lit("z"))) == (True, False, False)
    assert one(spark, wording.home_country(null, F.lit("Bandung")), wording.home_country(null, F.lit("Kuala Lumpur, Malaysia")), wording.home_country(F.lit(" Japan "), null)) == ("Indonesia", None, "Japan")
    assert one(spark, wording.source_name(F.lit(" JOBSTREET ")), wording.source_name(F.lit("other source")), wording.location_key(F.lit(" A  B"), null, F.lit("C"))) == ("JobStreet", "Other Source", "a b|c")
    assert one(spark, wording.missing_context(null, F.lit(" "), F.array(F.lit("a")), F.array().cast("array<string>"))) == (["title", "description", "skills"],)
    assert one(spark, wording.limited_summary(null, null, null, null))[0].startswith("Unknown position at unknown company (location unavailable).")
