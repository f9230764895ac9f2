"""Crawl frontier against sequential loops."""

import random

import pytest
from pyspark.sql import functions as F

from vacancia.operators import frontier as R


def loop_stop(pages, n, max_pages):
    """Pages read by a crawler that goes on page by page."""
    read, streak = 0, 0
    for links, new in pages:
        if max_pages and read >= max_pages:
            break
        read += 1
        if links == 0:
            break
        streak = 0 if new else streak + 1
        if streak >= n:
            break
    return read


@pytest.mark.parametrize("n, max_pages, block", [(3, 0, 4), (3, 0, 3), (9, 0, 16), (2, 25, 5), (1, 0, 7)])
def test_stop_equals_sequential_loop(spark, n, max_pages, block):
    rng = random.Random(n)
    runs = {}
    for i in range(60):
        first, length = rng.choice([0, 1]), rng.randint(1, 60)
        density = rng.choice([0.05, 0.3, 0.8])
        pages = [(0 if rng.random() < 0.01 else 5, int(rng.random() < density)) for _ in range(length)]
        runs[f"s{i}"] = (first, pages)
    rows = [(s, first + i, links, new if links else 0) for s, (first, pages) in runs.items() for i, (links, new) in enumerate(pages)]
    stats = spark.createDataFrame(rows, "source string, page bigint, n_links bigint, n_new bigint")
    kept = R.truncate_after_known_pages(stats, "source", "page", n, max_pages, block)
    got = {r["source"]: r["count"] for r in kept.groupBy("source").count().collect()}
    assert got == {s: loop_stop(pages, n, max_pages) for s, (_, pages) in runs.items()}


def test_documented_streak(spark):
    rows = [("s", i, 1, new) for i, new in enumerate([1, 0, 0, 1, 0, 0, 0, 1])]
    stats = spark.createDataFrame(rows, "source string, page bigint, n_links bigint, n_new bigint")
    assert R.truncate_after_known_pages(stats, "source", "page", 3).count() == 7


def test_discovery_equals_sequential_loop(spark):
    """Links of all pages -> first seen, not known, until the run is caught up."""
    rng = random.Random(5)
    pages = [[f"u{rng.randint(0, 80)}" for _ in range(rng.randint(1, 6))] for _ in range(50)]
    known = {f"u{i}" for i in range(0, 80, 3)}
    seen, want, streak = set(), [], 0
    for urls in pages:
        fresh = [u for u in dict.fromkeys(urls) if u not in seen and u not in known]
        seen.update(urls)
        want += fresh
        streak = 0 if fresh else streak + 1
        if streak >= 2:
            break
    links = spark.createDataFrame(
        [("s", p, i, u) for p, urls in enumerate(pages) for i, u in enumerate(urls)],
        "source string, page bigint, pos int, url string",
    )
    fresh = R.new_urls(
        R.first_seen(links, ["source", "url"], ["page", "pos"]), spark.createDataFrame([(u,) for u in known], "url string")
    )
    stats = R.page_stats(links.select("source", "page").distinct(), links, fresh, ["source", "page"])
    stop = R.stop_pages(stats, "source", "page", 2, block=8).first()["stop_page"]
    got = [r["url"] for r in fresh.filter(F.col("page") <= stop).orderBy("page", "pos").collect()]
    assert got == want
    capped = R.cap(fresh.filter(F.col("page") <= stop), 5, ["page", "pos"]).collect()
    assert [r["url"] for r in capped] == want[:5]
    assert R.cap(fresh, 0, ["page"]).count() == fresh.count()


def test_outcomes(spark):
    rows = [("a", 200, None), ("b", 404, None), ("c", 410, None), ("d", 500, None), ("e", 200, "no_details_extracted"),
            ("f", None, "Timeout: " + "x" * 200), ("g", 200, "parse_error: y")]
    got = spark.createDataFrame(rows, "url string, status int, error string").withColumn(
        "outcome", R.classify_outcome(F.col("status"), F.col("error")))
    assert {r["url"]: r["outcome"] for r in got.collect()} == {
        "a": "ok", "b": "gone", "c": "gone", "d": "retry", "e": "gone", "f": "retry", "g": "retry"}
    reasons = {r["url"]: r["reason"] for r in R.failed_records(got, "now").collect()}
    assert reasons == {"d": "http_500", "e": "gone_no_details", "f": ("Timeout: " + "x" * 200)[:100], "g": "parse_error: y"}


def test_batches_are_consecutive(spark):
    df = spark.range(0, 1001, 1, 8).select((F.lit(1000) - F.col("id")).alias("id"))
    got = {(r["id"], r["batch_no"]) for r in R.assign_batches(df, 50, ["id"]).collect()}
    assert got == {(i, i // 50) for i in range(1001)}


def test_sitemap(spark):
    xml = "<urlset><url><loc>\n https://h/a?x=1&amp;y=2 </loc><image:loc>no</image:loc></url><url><loc>https://h/b</loc></url></urlset>"
    rows = R.extract_locs(spark.createDataFrame([(1, xml)], "id int, xml string"), "xml").collect()
    assert [(r["pos"], r["url"]) for r in rows] == [(0, "https://h/a?x=1&y=2"), (1, "https://h/b")]


def test_run_stops_before_a_missing_page(spark):
    pages = [(s, p, 2, 1) for s, ps in {"a": [0, 1, 3, 4], "b": range(6, 12), "c": [7, 9], "d": [6, 7, 8, 20]}.items() for p in ps]
    stats = spark.createDataFrame(pages, "source string, page long, n_links long, n_new long")
    got = {r["source"]: r["stop_page"] for r in R.stop_pages(stats, "source", "page", 2, block=8).collect()}
    assert got == {"a": 1, "b": 11, "c": 7, "d": 8}


def test_links_in_all_quotings(spark):
    html = """<a href='/1'><A class=x HREF = "/2?a=1&amp;b=2"><a data-href="/no" href=/3><!-- <a href="/no"> --><a data-href="/no">"""
    row = spark.createDataFrame([(html,)], "html string").select(R.hrefs(F.col("html")).alias("l")).first()
    assert row["l"] == ["/1", "/2?a=1&b=2", "/3"]


def test_links_read_as_a_browser_does(spark):
    html = """<a data-x="1>2" href="/ok"><div title='<a href="/no">'><a href=/p/?a=1&copy=2&amp;b><abbr href="/no"><A
    HREF='/x"y'/><a href><script>"<a href='/no'>"</script><a name=n><!-- <a href="/no"> """
    row = spark.createDataFrame([(html,), (None,)], "html string").select(R.hrefs(F.col("html")).alias("l")).collect()
    assert [r["l"] for r in row] == [["/ok", "/p/?a=1&copy=2&b", '/x"y'], []]


def test_run_needs_its_first_page(spark):
    pages = [(s, p, 2, 1) for s, ps in {"a": [3, 4, 5], "b": [1, 2, 4], "c": [0, 1, 2]}.items() for p in ps]
    stats = spark.createDataFrame(pages, "source string, page long, n_links long, n_new long")
    got = R.stop_pages(stats, "source", "page", 2, block=8, first_page=1).collect()
    assert {r["source"]: r["stop_page"] for r in got} == {"a": 0, "b": 2, "c": 2}
    left = R.truncate_after_known_pages(stats, "source", "page", 2, block=8, first_page=1).collect()
    assert {(r["source"], r["page"]) for r in left} == {("b", 1), ("b", 2), ("c", 1), ("c", 2)}
