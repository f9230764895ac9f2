"""Crawl frontier: links of fetched pages, what is new, when to stop, what a run achieved."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia import fixed_values as V
from vacancia.functions.tags import anchors, value_of
from vacancia.operators.dedup import latest_by
from vacancia.operators.keys import assign_keys


def unescape_entities(col: Column) -> Column:
    """The five predefined XML entities, `&amp;` last."""
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]:
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def extract_locs(df: DataFrame, xml_col: str) -> DataFrame:
    """All `<loc>` texts of a sitemap with their position."""
    locs = F.regexp_extract_all(xml_col, F.lit(r"<loc>\s*([^<]*?)\s*</loc>"), F.lit(1))
    others = [c for c in df.columns if c != xml_col]
    return df.select(*others, F.posexplode(locs).alias("pos", "_loc")).select(
        *others, "pos", unescape_entities(F.col("_loc")).alias("url")
    )


def hrefs(html: Column, before: str = "") -> Column:
    """Link targets of all anchors, optionally only of anchors right after a pattern.

    Anchors are read as a browser does: values in either quotes or none, `>` within them, and neither in
    comments, an unclosed one included, nor in scripts.
    """
    return F.array_compact(F.transform(anchors(html, before), lambda tag: value_of(tag, "href")))


def extract_links(df: DataFrame, html_col: str, contains: str = "") -> DataFrame:
    """Anchors with their position in the page; only link targets holding the given text."""
    others = [c for c in df.columns if c != html_col]
    links = df.select(*others, F.posexplode(hrefs(F.col(html_col))).alias("pos", "href"))
    return links.filter(F.col("href").contains(contains)) if contains else links


def first_seen(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Each key once, where it occurs first in discovery order."""
    return latest_by(df, key, [F.col(c).asc() for c in order])


def new_urls(found: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """Found URLs that the checkpoint does not hold."""
    return found.join(known.select(key), key, "left_anti")


def page_stats(pages: DataFrame, links: DataFrame, fresh: DataFrame, page: list[str]) -> DataFrame:
    """Per page: how many links it has and how many of them are unseen; pages without links count 0."""
    n_links = links.groupBy(*page).agg(F.count(F.lit(1)).alias("n_links"))
    n_new = fresh.groupBy(*page).agg(F.count(F.lit(1)).alias("n_new"))
    zero = F.lit(0).cast("bigint")
    return (
        pages.select(*page)
        .join(n_links, page, "left")
        .join(n_new, page, "left")
        .select(
            *page,
            F.coalesce("n_links", zero).alias("n_links"),
            F.coalesce("n_new", zero).alias("n_new"),
        )
    )


def stop_pages(
    stats: DataFrame, source: str, page: str, n: int, max_pages: int = 0, block: int = 4096, first_page: int | None = None
) -> DataFrame:
    """Per source, the last page a run reads.

    A run begins at `first_page`, where that is given: a source whose first page failed to load stops before it,
    at `first_page` - 1. Else it begins at the first page there is. It stops at the n-th consecutive page without unseen links, at the first page without links,
    before a page that is missing because it failed to load, or at the page cap (0 = no cap). A run
    of n pages is at most n long, so pages are cut into blocks and each block also sees the n-1 pages
    before it and the one after it: no source has to fit into one task.
    """
    block = max(block, n)
    if first_page is not None:
        stats = stats.filter(F.col(page) >= first_page)
    home = F.floor(F.col(page) / block)
    next_block = F.when(F.pmod(F.col(page), F.lit(block)) >= block - (n - 1), home + 1)
    block_before = F.when(F.pmod(F.col(page), F.lit(block)) == 0, home - 1)
    spread = stats.select(
        source, page, "n_links", "n_new", home.alias("_home"),
        F.explode(F.array_compact(F.array(home, next_block, block_before))).alias("_block"),
    )
    in_order = Window.partitionBy(source, "_block").orderBy(page)
    last_n = Window.partitionBy(source, "_block").orderBy(page).rangeBetween(-(n - 1), 0)
    streaks = spread.select(
        source,
        page,
        "n_links",
        (F.col("_home") == F.col("_block")).alias("_at_home"),
        F.lead(page).over(in_order).alias("_next"),
        F.count(F.lit(1)).over(last_n).alias("_pages"),
        F.sum(F.when(F.col("n_new") > 0, 1).otherwise(0)).over(last_n).alias("_productive"),
    )
    caught_up = (F.col("_pages") == n) & (F.col("_productive") == 0)
    next_missing = F.col("_at_home") & (F.col("_next").isNull() | (F.col("_next") > F.col(page) + 1))
    stops = streaks.groupBy(source).agg(
        F.min(F.when(caught_up | (F.col("n_links") == 0) | next_missing, F.col(page))).alias("_stop"),
        F.min(page).alias("_first"),
        F.max(page).alias("_last"),
    )
    first = F.col("_first") if first_page is None else F.lit(first_page).cast(stats.schema[page].dataType)
    cap = first + max_pages - 1 if max_pages else F.col("_last")
    stop = F.least(F.coalesce("_stop", "_last"), cap)
    return stops.select(source, F.when(F.col("_first") > first, first - 1).otherwise(stop).alias("stop_page"))


def truncate_after_known_pages(
    stats: DataFrame, source: str, page: str, n: int, max_pages: int = 0, block: int = 4096, first_page: int | None = None
) -> DataFrame:
    """Page statistics up to and including the page where the run stops."""
    stops = stop_pages(stats, source, page, n, max_pages, block, first_page)
    if first_page is not None:
        stats = stats.filter(F.col(page) >= first_page)
    return stats.join(stops, source).filter(F.col(page) <= F.col("stop_page")).drop("stop_page")


def cap(df: DataFrame, k: int, order: list[str]) -> DataFrame:
    """The first k rows in discovery order; 0 means no limit."""
    return df.orderBy(*order).limit(k) if k else df


def assign_batches(df: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Consecutive batches of `size` rows in discovery order, numbered from 0."""
    numbered = assign_keys(df, order, "_row")
    return numbered.withColumn("batch_no", F.floor((F.col("_row") - 1) / size)).drop("_row")


def classify_outcome(status: Column, error: Column) -> Column:
    """`ok`, `gone` (never fetch again) or `retry`."""
    return (
        F.when(status.isin(V.GONE_STATUSES) | error.eqNullSafe(F.lit(V.GONE_ERROR)), F.lit("gone"))
        .when((status == 200) & error.isNull(), F.lit("ok"))
        .otherwise(F.lit("retry"))
    )


def advance_checkpoint(known: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Known URLs plus those fetched or gone for good."""
    final = outcomes.filter(F.col("outcome").isin("ok", "gone"))
    return known.select("url").unionByName(final.select("url")).distinct()


def failed_records(outcomes: DataFrame, stamp: str, max_chars: int = 100) -> DataFrame:
    """One record per failed fetch; a page that answers without a posting is listed as gone."""
    no_posting = F.col("error").eqNullSafe(F.lit(V.GONE_ERROR))
    reason = F.when(no_posting, F.lit(V.GONE_REASON)).otherwise(
        F.coalesce(F.substring("error", 1, max_chars), F.concat(F.lit("http_"), F.col("status").cast("string")))
    )
    return outcomes.filter((F.col("outcome") == "retry") | no_posting).select(
        "url", F.lit(stamp).alias("attempted_at"), reason.alias("reason")
    )


def run_summary(outcomes: DataFrame, checkpoint: DataFrame | None = None) -> DataFrame:
    """Counts per outcome and, if given, the size of the checkpoint."""
    counts = outcomes.groupBy(F.col("outcome").alias("metric")).agg(F.count(F.lit(1)).alias("n"))
    if checkpoint is None:
        return counts
    total = checkpoint.agg(F.count(F.lit(1)).alias("n")).select(F.lit("checkpoint_total").alias("metric"), "n")
    return counts.unionByName(total)


def checkpoint_orphans(known: DataFrame, *stored: DataFrame) -> DataFrame:
    """URLs marked known although no stored file holds them."""
    urls = reduce(DataFrame.unionByName, [df.select("url") for df in stored])
    return known.select("url").join(urls, "url", "left_anti")
