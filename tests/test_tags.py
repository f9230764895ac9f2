"""The tag stream against an event parser, on the given pages and on pages that break the rules."""

import html as H
import random
import re

from html_reader import read_page
from pyspark.sql import functions as F

from vacancia.functions import tags as G
from vacancia.operators import extract as X

SPEC = {
    "title": X.FieldSpec(["title"]), "h1": X.FieldSpec(["article h1"]), "nav": X.FieldSpec(["nav ul li a"], attribute="href"),
    "ads": X.FieldSpec(["div.ad"]), "p": X.FieldSpec(["article p", "footer"]), "li": X.FieldSpec(["ul"], child=("li", 1)),
    "body": X.FieldSpec(["body"]),
}
ODD = {
    "x": X.FieldSpec([".x"]), "xy": X.FieldSpec(["div.x.y b", "#i"]), "in": X.FieldSpec(["div div"]), "src": X.FieldSpec(["img"], attribute="src"),
    "child": X.FieldSpec(["ul.x"], child=("li", 1)), "p": X.FieldSpec(["p"]), "all": X.FieldSpec(["div", "p.x", "b"]),
}


def found(spark, rows, spec):
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, html string")
    got = X.extract_fields(pages, "html", spec).select("page_id", "fields").collect()
    return {r["page_id"]: [list(values) for values in r["fields"]] for r in got}


def test_given_pages(spark):
    rows = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    assert found(spark, rows, SPEC) == {i: read_page(html, SPEC) for i, html in enumerate(rows)}


def test_pages_out_of_order(spark):
    """Tags drawn at random: unclosed, closed twice, crossing, in comments and raw text, with odd attributes."""
    rng = random.Random(7)
    pieces = [
        "<div class=x>", '<div class="y  x">', "</div>", "<p>", '<p class="x>y">', "</p>", "<b>", "</b>", "<ul class='x'>", "</ul>", "<li>", "</li>",
        "<br>", "<br/>", "<img src='a.png'>", '<img src="b&amp;c" src=d>', "<div id=i/>", "<span", ">", "<", " < b", "one", " two\n", "&amp;", "&lt;b&gt;",
        "&notit;", "&#233;", "&#x80;", "&nosuch;", "&", "<!-- <div> -->", "<!--x-->", "<script>'<div class=x>' </p></script>", "<style>p{}</style>",
        "<template>", "</template>", "<!DOCTYPE html>", "<?php x ?>", "\u00a0", "<DIV CLASS=x>", "</DIV >", "<p\nclass='x'\ttitle=\"a 'b' >\">",
    ]
    rows = ["".join(rng.choice(pieces) for _ in range(rng.choice([3, 12, 60]))) for _ in range(400)]
    # A tag that is cut off by the next one is text here, but swallows it there.
    rows = [r for r in rows if not re.search("<(one|span)[^>]*<|<(one|span)[^>]*$", r)]
    assert len(rows) > 200
    got = found(spark, rows, ODD)
    wrong = [(r, got[i], read_page(r, ODD)) for i, r in enumerate(rows) if got[i] != read_page(r, ODD)]
    assert not wrong, wrong[0]


def test_empty_and_long_pages(spark):
    deep = "<div class=x>" * 300 + "in" + "</div>" * 300
    long = "<p>" + "word &amp; " * 20000 + "</p>" + "<p data-x='" + "y" * 50000 + "'>z</p>"
    rows = [None, "", "   ", "no tags", deep, long]
    spec = {"x": X.FieldSpec(["p"])}
    assert found(spark, rows, spec) == {i: read_page(r, spec) for i, r in enumerate(rows)}
    assert len(found(spark, [deep], {"x": X.FieldSpec([".x"])})[0][0]) == 300


def test_character_references(spark):
    texts = ["&eacute;&copy=1 &copy;x &ampx &#0; &#xD800; &#x110000; &#150; &#1; &#65 &NotEqualTilde; &&amp;amp; a & b &;", "none", "&#x1F600;&hearts"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(G.unescape(F.col("t")).alias("u")).collect()
    assert [r["u"] for r in rows] == [H.unescape(t) for t in texts]
    row = spark.createDataFrame([("?a=1&copy=2&lt=3&lt;&eacute&copy",)], "t string").select(G.unescape(F.col("t"), in_attribute=True).alias("u"))
    assert row.first()["u"] == "?a=1&copy=2&lt=3<é©"


def test_selector_chain(spark):
    chain = ["h2.search-job-title a.search-job-title-link", "h2 a[href*='/jobs/']", "h3 a[href*='/jobs/']", "a[href*='/jobs/']"]
    rows = [
        '<h2 class="a search-job-title"><span><a class="search-job-title-link b" href="/1">x</a></span></h2><h2><a href="/jobs/no">',
        '<h2 class="search-job-title"><a href="/jobs/2?a=1&amp;b=2"></a><a href="/other"></a></h2><h3><a href="/jobs/no"></a></h3>',
        "<h3 title='a>b'><a href=/jobs/3></a></h3><p><a href='/jobs/no'></a>", '<p><a href="/jobs/4"></a><a href=""></a><a></a>', "<a href='/x'>", None,
    ]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, html string")
    got = X.select_links(pages, "html", chain).collect()
    assert [tuple(r) for r in got] == [(0, 0, "/1"), (1, 0, "/jobs/2?a=1&b=2"), (2, 0, "/jobs/3"), (3, 0, "/jobs/4")]


def test_selectors():
    (step,) = G.parse_selector("a.b.c#d[data-x='1 2'][href]")
    assert step == G.Step("a", ("b", "c"), "d", (("data-x", "=", "1 2"), ("href", "", "")))
    assert [s.tag for s in G.parse_selector(" DIV  * p")] == ["div", "", "p"]
