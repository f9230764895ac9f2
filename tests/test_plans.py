"""Properties of validation and Silver, and of the physical plans behind them."""

import re

import pytest
from pyspark.sql import functions as F

from checks.postings import raw_postings
from vacancia.functions.text import map_city
from vacancia.operators import extract as X
from vacancia.operators import frontier as R
from vacancia.operators.dedup import latest_by
from vacancia.operators.validate import observed, require_rows, split_valid
from vacancia.plans import silver as P

NOW = "2031-01-01 00:00:00"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_valid_and_rejected_add_up(spark, sf):
    raw = raw_postings(spark, sf)
    valid, rejected = split_valid(raw)
    assert valid.count() + rejected.count() == raw.count()
    assert rejected.filter(F.size("reject_reasons") == 0).count() == 0


def test_require_rows(spark):
    with pytest.raises(ValueError):
        require_rows(spark.range(0), "x")


def test_rows_are_counted_while_written(spark, tmp_path):
    df, seen = observed(spark.range(7), "written")
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == 7


def test_silver_has_no_python_and_no_single_task(spark, sf):
    text = plan(P.silver_batch(raw_postings(spark, sf), NOW)[0])
    assert "Python" not in text and "SinglePartition" not in text and "CartesianProduct" not in text
    assert text.count("Exchange hashpartitioning") == 2  # the two keys


def test_dedup_reduces_before_the_shuffle(spark, sf):
    text = plan(P.deduplicate(P.standardize(raw_postings(spark, sf), NOW)))
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 2


def test_hot_key_leaves_one_row_per_map_task(spark):
    """Half of the rows share one key; the shuffle carries a row per task of it."""
    df = spark.range(0, 200000, 1, 16).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"), "id"
    )
    got = latest_by(df, ["key"], [F.col("id").desc()])
    assert got.count() == 100001 and got.filter("key = 'hot'").first()["id"] == 199998
    assert "Partial" in plan(got)


def test_frontier_blocks_bound_every_window(spark):
    """One source with all pages is cut into blocks of pages."""
    stats = spark.range(0, 100000, 1, 8).select(
        F.lit("s").alias("source"), F.col("id").alias("page"), F.lit(1).alias("n_links"),
        (F.col("id") != 77777).cast("int").alias("n_new"),
    )
    text = plan(R.stop_pages(stats, "source", "page", 1))
    assert re.search(r"Exchange hashpartitioning\(_block#\d+", text)
    assert R.stop_pages(stats, "source", "page", 1).first()["stop_page"] == 77777


def test_scan_is_pruned_and_filtered(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    text = plan(R.extract_links(pages.filter("page_id > 5").select("page_id", "html"), "html", "/"))
    assert "PushedFilters: [IsNotNull(page_id), GreaterThan(page_id,5)]" in text
    assert re.search(r"ReadSchema: struct<page_id:bigint,html:string>", text)


def test_no_python_reads_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    text = plan(X.flat_b_records(pages.select("url", "html"), "2026-01-01", "b"))
    assert "Python" not in text and "Exchange" not in text and "ReadSchema: struct<url:string,html:string>" in text


def test_city_map_is_one_literal(spark):
    text = plan(spark.createDataFrame([("x",)], "c string").select(map_city(F.col("c"))))
    assert "element_at(map(keys: [" in text and "Join" not in text


def test_state_is_parsed_once(spark):
    pages = spark.createDataFrame([("u", "h")], "url string, html string")
    text = plan(X.nested_records(pages, "now", "b"))
    assert text.count("from_json") == 1
