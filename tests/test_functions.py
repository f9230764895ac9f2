"""Column functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from vacancia import fixed_values as V
from vacancia.functions import arrays, classify, dates, ids, text, urls


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("v")).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def L(x):
    return F.lit(x).cast("string")


@pytest.mark.parametrize(
    "given, want",
    [
        ("2026-09-21T10:11:12+03:00", "2026-09-21 10:11:12"),
        ("2026-09-21T10:11:12.345Z", "2026-09-21 10:11:12"),
        ("2026-09-21 10:11:12", "2026-09-21 10:11:12"),
        (" 2026-09-21 ", "2026-09-21 00:00:00"),
        ("21/09/2026 10:11:12", "2026-09-21 10:11:12"),
        ("09/05/2026 10:11:12", "2026-09-05 10:11:12"),
        ("09/05/2026", "2026-09-05 00:00:00"),
        ("21/09/2026", "2026-09-21 00:00:00"),
        ("1/5/2026", "2026-01-05 00:00:00"),
        ("1790000000000", "2026-09-21 14:13:20"),
        ("1790000000", "2026-09-21 14:13:20"),
        ("2026-13-41 10:11:12", None),
        ("31/31/2026", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_ts(spark, given, want):
    assert one(spark, dates.parse_ts(L(given))) == want


@pytest.mark.parametrize(
    "given, want",
    [
        ("2026-09-21T10:11:12+03:00", "2026-09-21T10:11:12+03:00"),
        ("2026-09-21 10:11:12Z", "2026-09-21T10:11:12+00:00"),
        ("2026-09-21 10:11:12 +0300", "2026-09-21T10:11:12+03:00"),
        ("2026-09-21", "2026-09-21T00:00:00"),
        ("yesterday", "yesterday"),
        ("", None),
    ],
)
def test_lenient_iso(spark, given, want):
    assert one(spark, dates.lenient_iso(L(given))) == want


@pytest.mark.parametrize(
    "word", ["al-kharj north", "o'brien 2nd", "ÉCOLE élan", "حي al olaya", "straße ß ßa", "x1y2z", "  a", "-"]
)
def test_title_case_is_python_title(spark, word):
    assert one(spark, text.title_case(L(word))) == word.title()


@pytest.mark.parametrize(
    "given, want",
    [
        (" الرياض ", "Riyadh"), ("RIYADH", "Riyadh"), ("عسير", "'Asir"), ("al-kharj", "Al Kharj"),
        ("al-kharj north", "Al-Kharj North"), ("n/a", "Unknown"), ("  ", "Unknown"), ("NaN", "Unknown"), (None, "Unknown"),
    ],
)
def test_map_city(spark, given, want):
    assert one(spark, text.map_city(L(given))) == want


def test_map_city_exact_key_after_lower_case_key(spark):
    names = {"abc": "lower", "ABC": "upper", "Xyz": "exact"}
    got = [one(spark, text.map_city(L(c), names)) for c in ("ABC", "Xyz", "XYZ")]
    assert got == ["lower", "exact", "Xyz"]


def test_city_table_is_whole():
    assert len(V.CITY_NAMES) == 105 and len(set(V.CITY_NAMES.values())) == 80


@pytest.mark.parametrize(
    "given, want",
    [
        ("<p>a</p>\n\n b", "a b"), ("a\x0bb", "a b"), ("a\xa0&amp; b", "a\xa0&amp; b"), ("a < b", "a < b"),
        ("<br>", ""), ("  plain  text ", "plain text"), (None, None),
    ],
)
def test_clean_html(spark, given, want):
    assert one(spark, text.clean_html(L(given))) == want


@pytest.mark.parametrize(
    "low, high, currency, want",
    [
        ("5000", "7000", "USD", "5000 - 7000 USD"), ("5000", None, None, "5000 SAR"), ("5000", "0", "", "5000 SAR"),
        ("0", "7000", "USD", None), ("0.0", None, None, None), ("", "1", None, None), (None, None, None, None),
    ],
)
def test_salary_text(spark, low, high, currency, want):
    assert one(spark, text.salary_text(L(low), L(high), L(currency))) == want


@pytest.mark.parametrize(
    "low, high, want",
    [("1", "3", "1 - 3 years"), ("1", None, "1 years"), (None, "3", "3 years"), ("0", "0", None), (None, None, None)],
)
def test_experience_text(spark, low, high, want):
    assert one(spark, text.experience_text(L(low), L(high))) == want


def test_city_from_location(spark):
    def city(c, loc):
        return one(spark, text.city_from_location(L(c), L(loc)))

    assert city(None, "Olaya, Riyadh") == "Riyadh"
    assert city("", "Riyadh") == "Riyadh"
    assert city("Jeddah", "Olaya, Riyadh") == "Jeddah"
    assert city(None, None) == ""


def test_first_match_wins_and_null_gives_default(spark):
    assert one(spark, classify.work_mode(L("Hybrid / remote"))) == "Remote"
    assert one(spark, classify.work_mode(L(None))) == "On-site"
    assert one(spark, classify.qualification(L("Master or BACHELOR"))) == "Bachelor's Degree"
    assert one(spark, classify.employment_type(L(None))) == "Unknown"


def test_last_allowed_tag(spark):
    tags = F.array(L("Remote"), L("x"), L("ON-SITE"), L("Full Time"))
    assert one(spark, classify.classify_tags(tags, V.TAG_WORK_MODES)) == "ON-SITE"
    assert one(spark, classify.classify_tags(F.array(L("x")), V.TAG_WORK_MODES)) is None


def test_kv_map_last_label_wins(spark):
    got = one(spark, arrays.kv_map(F.array(L("a"), L(None), L("b"), L("a")), F.array(L("1"), L("2"), L("3"), L("4"))))
    assert got == {"a": "4", "b": "3"}


def test_split_skills(spark):
    def names(x):
        return one(spark, arrays.split_skills(L(x), "Not Specified"))

    assert names("python; sql , python,, ;Power BI") == ["python", "sql", "Power BI"]
    assert names("Not Specified") == []


@pytest.mark.parametrize(
    "href, want",
    [
        ("/ar/jobs/p/1?x=1#y", "https://host/jobs/p/1"), ("https://host/ar/jobs#x", "https://host/jobs"),
        ("//other/a?b", "https://other/a"), ("jobs/2", "https://host/jobs/2"), ("mailto:x@y", "mailto:x@y"),
        ("https://host/barrier/ar/1", "https://host/barrier/ar/1"),
    ],
)
def test_normalize_url(spark, href, want):
    assert one(spark, urls.normalize_url(L(href), "https://host")) == want


def test_host_is_exact(spark):
    for url, want in [("https://a.b/x", True), ("https://x.a.b/", False), ("https://a.b:80/", False), ("/a.b", False)]:
        assert one(spark, urls.host_is(L(url), "a.b")) is want


def test_ids(spark):
    import hashlib

    assert one(spark, ids.slug_id(L("https://h/jobs/p/abc-1?x"))) == hashlib.sha1(b"abc-1").hexdigest()[:12]
    assert one(spark, ids.slug_id(L("https://h/x"))) == hashlib.sha1(b"https://h/x").hexdigest()[:12]
    want = hashlib.md5(b"src_title").hexdigest()[:12]
    assert one(spark, ids.job_id(L(" SRC"), L(None), L("Title "))) == want


def test_white_space_of_any_kind_is_cut_off(spark):
    from vacancia.functions.text import map_city

    df = spark.createDataFrame([("\nالرياض\n",), ("Riyadh\xa0",), ("\tRiyadh ",)], "c string")
    assert {r[0] for r in df.select(map_city(df.c)).collect()} == {"Riyadh"}
