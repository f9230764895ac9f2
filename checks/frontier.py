"""Crawl-frontier and extraction queries over `pages`, `events` and derived page texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql as Q
from checks.postings import raw_postings
from checks.registry import check, scratch, table
from vacancia import fixed_values as V
from vacancia.context import spread
from vacancia.functions.arrays import first_nonempty, join_list, kv_map
from vacancia.functions.classify import classify_tags
from vacancia.functions.dates import lenient_iso
from vacancia.functions.ids import slug_id
from vacancia.functions.urls import absolute_url, host_is, host_of, normalize_url
from vacancia.operators import extract as X
from vacancia.operators import frontier as R
from vacancia.sources.json_export import write_checkpoint
from vacancia.sources.landing import read_checkpoint, rebuild_checkpoint

BASE = "https://host.example"
STAMP = "2030-01-02 03:04:05"

# The given pages taken as listing pages of three portals, links made absolute.
LINKS_SQL = """
links AS (
  SELECT 'p' || CAST(page_id % 3 AS STRING) AS source, page_id // 3 AS page, pos, 'https://host.example' || href AS url
  FROM (SELECT page_id, unnest(hs) AS href, generate_subscripts(hs, 1) - 1 AS pos FROM (
    SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS hs FROM pages))
  WHERE contains(href, '/')
),
firsts AS (
  SELECT * FROM links QUALIFY row_number() OVER (PARTITION BY source, url ORDER BY page, pos) = 1
),
known AS (SELECT DISTINCT url FROM links WHERE url < 'https://host.example/m'),
fresh AS (SELECT * FROM firsts WHERE url NOT IN (SELECT url FROM known)),
stats AS (
  SELECT p.source, p.page, count(DISTINCT l.pos) AS n_links, count(DISTINCT f.pos) AS n_new
  FROM (SELECT 'p' || CAST(page_id % 3 AS STRING) AS source, page_id // 3 AS page FROM pages) p
  LEFT JOIN links l ON p.source = l.source AND p.page = l.page
  LEFT JOIN fresh f ON p.source = f.source AND p.page = f.page
  GROUP BY p.source, p.page
)"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), (F.col("page_id") % 3).cast("string")).alias("source"),
        F.floor(F.col("page_id") / 3).alias("page"),
        "html",
    )


def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = R.extract_links(listing(spark, sf_dir), "html", contains="/")
    return links.select("source", "page", "pos", absolute_url(F.col("href"), BASE).alias("url"))


def known_urls(links: DataFrame) -> DataFrame:
    return links.filter(F.col("url") < "https://host.example/m").select("url").distinct()


def fresh_links(links: DataFrame) -> DataFrame:
    return R.new_urls(R.first_seen(links, ["source", "url"], ["page", "pos"]), known_urls(links))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = listing_links(spark, sf_dir)
    return R.page_stats(listing(spark, sf_dir), links, fresh_links(links), ["source", "page"])


@check(
    "a6_rebuild_checkpoint",
    f"""{Q.WITH_RAW} SELECT DISTINCT url FROM
      (SELECT url FROM pages UNION ALL SELECT trim(raw_job_url) FROM raw) WHERE url <> ''""",
)
def _(spark, sf_dir):
    stored = raw_postings(spark, sf_dir).select(F.trim("raw_job_url").alias("url"))
    return rebuild_checkpoint(table(spark, sf_dir, "pages"), stored)


@check("a6_write_checkpoint", "SELECT DISTINCT url || ' \"' || CAST(page_id % 7 AS STRING) AS url FROM pages WHERE url <> ''")
def _(spark, sf_dir):
    """A set of URLs written as a checkpoint and read again."""
    path = scratch(spark)
    write_checkpoint(table(spark, sf_dir, "pages").selectExpr("url || ' \"' || page_id % 7 AS url"), path)
    return read_checkpoint(spark, path)


@check(
    "b1_extract_locs",
    """SELECT page_id, CAST(i AS INT) AS pos, CASE i WHEN 0 THEN url ELSE 'https://host/?a=' || CAST(page_id AS STRING) || '&b=<' END AS url
       FROM pages, (VALUES (0), (1)) AS t(i)""",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    xml = F.concat(
        F.lit("<urlset><url><loc> "),
        F.replace("url", F.lit("&"), F.lit("&amp;")),
        F.lit("\n</loc></url><url><loc>https://host/?a="),
        F.col("page_id").cast("string"),
        F.lit("&amp;b=&lt;</loc></url></urlset>"),
    )
    return R.extract_locs(pages.select("page_id", xml.alias("xml")), "xml")


@check("b2_extract_links", f"WITH {LINKS_SQL} SELECT source, page, CAST(pos AS INT) AS pos, url FROM links")
def _(spark, sf_dir):
    return listing_links(spark, sf_dir)


@check(
    "b3_first_nonempty",
    """SELECT page_id, len(l) AS n, list_extract(l, 1) AS head FROM (SELECT page_id,
         CASE WHEN len(a) > 0 THEN a WHEN len(b) > 0 THEN b ELSE c END AS l FROM (SELECT page_id,
           regexp_extract_all(html, '<h2[^>]*>\\s*<a\\s[^>]*href="([^"]*)"', 1) AS a,
           regexp_extract_all(html, '<p>\\s*<a\\s[^>]*href="([^"]*)"', 1) AS b,
           regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS c FROM pages))""",
)
def _(spark, sf_dir):
    html = F.col("html")
    chain = first_nonempty(
        R.hrefs(html, r"<h2[^>]*>\s*"), R.hrefs(html, r"<p>\s*"), R.hrefs(html)
    )
    picked = table(spark, sf_dir, "pages").select("page_id", chain.alias("l"))
    return picked.select(
        "page_id", F.size("l").cast("bigint").alias("n"), F.try_element_at("l", F.lit(1)).alias("head")
    )


@check(
    "b3_selector_chain",
    """WITH kinds AS (SELECT page_id, page_id % 5 AS kind FROM pages)
       SELECT page_id, CAST(i AS INT) AS pos, '/jobs/' || CAST(page_id AS STRING) || '?n=' || CAST(i AS STRING) || '&k=' || CAST(kind AS STRING) AS href
       FROM kinds, (VALUES (0), (1)) AS t(i) WHERE kind < 4""",
)
def _(spark, sf_dir):
    """Result pages in four layouts of their links, and a fifth without any, around the given pages."""
    kind = F.col("page_id") % 5
    layouts = [
        ("<h2 class='x search-job-title' data-x=\"1>2\"><b><a class='search-job-title-link y' href=\"", "\">t</a></b></h2>", "<h2><a href='/jobs/no'>n</a></h2>"),
        ("<h2 class=x><a data-y='</h2>' href='", "'>t</a></h2>", "<h3><a href='/jobs/no'>n</a></h3>"),
        ("<div><h3><i></i><a href='", "'>t</a></h3></div>", "<p><a href='/jobs/no'>n</a>"),
        ("<p><a href=", " class=z>t</a>", "<!-- <h2><a href='/jobs/no'></a></h2> -->"),
        ("<p><a href='/x' title='", "'>t</a>", "<script>'<a href=/jobs/no>'</script>"),
    ]
    target = [
        F.concat(F.lit("/jobs/"), F.col("page_id").cast("string"), F.lit(f"?n={i}&amp;k="), kind.cast("string")) for i in (0, 1)
    ]
    links = F.lit("")
    for k, (before, after, other) in enumerate(layouts):
        parts = [F.lit(other), F.lit(before), target[0], F.lit(after), F.lit(before), target[1], F.lit(after)]
        links = F.when(kind == k, F.concat(*parts)).otherwise(links)
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(links, F.col("html")).alias("html"))
    return X.select_links(pages, "html", V.RESULT_LINKS)


@check(
    "b4_normalize_url",
    """WITH variants AS (SELECT page_id, kind, CASE kind
         WHEN 0 THEN '/ar/jobs/p/' || CAST(page_id AS STRING) || '?x=1#y'
         WHEN 1 THEN '//host.example/ar/jobs/' || CAST(page_id AS STRING) || '#y'
         WHEN 2 THEN 'jobs/' || CAST(page_id AS STRING) ELSE url END AS href
       FROM pages, (VALUES (0), (1), (2), (3)) AS t(kind))
       SELECT page_id, kind, split_part(split_part(replace(
         CASE WHEN kind = 3 THEN href WHEN kind = 1 THEN 'https:' || href
              WHEN kind = 0 THEN 'https://host.example' || href ELSE 'https://host.example/' || href END,
         'https://host.example/ar/', 'https://host.example/'), '?', 1), '#', 1) AS url FROM variants""",
)
def _(spark, sf_dir):
    kinds = F.explode(F.array(*[F.lit(i) for i in range(4)]))
    base = table(spark, sf_dir, "pages").select("page_id", "url", kinds.alias("kind"))
    page = F.col("page_id").cast("string")
    href = (
        F.when(F.col("kind") == 0, F.concat(F.lit("/ar/jobs/p/"), page, F.lit("?x=1#y")))
        .when(F.col("kind") == 1, F.concat(F.lit("//host.example/ar/jobs/"), page, F.lit("#y")))
        .when(F.col("kind") == 2, F.concat(F.lit("jobs/"), page))
        .otherwise(F.col("url"))
    )
    return base.select("page_id", "kind", normalize_url(href, BASE).alias("url"))


@check(
    "b5_host_is",
    """SELECT page_id, url, split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1) AS host
       FROM pages WHERE split_part(split_part(url, '://', 2), '/', 1) = 'spam-farm.example.org'""",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", host_of(F.col("url")).alias("host"))
    return pages.filter(host_is(F.col("url"), "spam-farm.example.org"))


@check("b6_first_seen", f"WITH {LINKS_SQL} SELECT source, page, CAST(pos AS INT) AS pos, url FROM firsts")
def _(spark, sf_dir):
    return R.first_seen(listing_links(spark, sf_dir), ["source", "url"], ["page", "pos"])


@check("b7_new_urls", f"WITH {LINKS_SQL} SELECT source, page, CAST(pos AS INT) AS pos, url FROM fresh")
def _(spark, sf_dir):
    return fresh_links(listing_links(spark, sf_dir))


@check(
    "b8_truncate_after_known_pages",
    f"""WITH {LINKS_SQL},
    islands AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY page) AS island FROM stats),
    streaks AS (SELECT *, sum(CASE WHEN n_new = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source, island ORDER BY page) AS streak FROM islands),
    stops AS (SELECT source, coalesce(min(CASE WHEN streak >= 2 OR n_links = 0 THEN page END), max(page)) AS stop FROM streaks GROUP BY source)
    SELECT s.source, s.page, n_links, n_new FROM stats s JOIN stops t ON s.source = t.source WHERE s.page <= least(stop, 59)""",
)
def _(spark, sf_dir):
    return R.truncate_after_known_pages(stats(spark, sf_dir), "source", "page", n=2, max_pages=60, block=8)


@check(
    "b8_missing_first_page",
    """WITH stats AS (SELECT 'u' || CAST(event_id % 50 AS STRING) AS source, event_id // 50 AS page FROM events
         WHERE event_type <> 'purchase'),
    held AS (SELECT source, page, page - row_number() OVER (PARTITION BY source ORDER BY page) AS run FROM stats)
    SELECT source, count(*) AS pages, max(page) AS last_page FROM held WHERE run = -1 GROUP BY source""",
)
def _(spark, sf_dir):
    """Pages of some kind failed to load: a run ends before the first of them, be it the very first page."""
    pages = table(spark, sf_dir, "events").filter("event_type <> 'purchase'").select(
        F.concat(F.lit("u"), (F.col("event_id") % 50).cast("string")).alias("source"),
        F.floor(F.col("event_id") / 50).alias("page"), F.lit(1).alias("n_links"), F.lit(1).alias("n_new"),
    )
    kept = R.truncate_after_known_pages(pages, "source", "page", n=3, block=16, first_page=0)
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.max("page").alias("last_page"))


@check(
    "b8_streaks_over_events",
    """WITH stats AS (SELECT 'u' || CAST(event_id % 3 AS STRING) AS source, event_id // 3 AS page,
         1 AS n_links, CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS n_new FROM events),
    islands AS (SELECT *, sum(n_new) OVER (PARTITION BY source ORDER BY page) AS island FROM stats),
    streaks AS (SELECT *, sum(1 - n_new) OVER (PARTITION BY source, island ORDER BY page) AS streak FROM islands),
    stops AS (SELECT source, coalesce(min(CASE WHEN streak >= 9 THEN page END), max(page)) AS stop FROM streaks GROUP BY source)
    SELECT s.source, count(*) AS pages, CAST(sum(n_new) AS BIGINT) AS productive, max(page) AS last_page
    FROM stats s JOIN stops t ON s.source = t.source WHERE page <= stop GROUP BY s.source""",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), (F.col("event_id") % 3).cast("string")).alias("source"),
        F.floor(F.col("event_id") / 3).alias("page"),
        F.lit(1).alias("n_links"),
        F.col("event_type").isin("view", "click").cast("int").alias("n_new"),
    )
    kept = R.truncate_after_known_pages(pages, "source", "page", n=V.KNOWN_PAGES_NESTED)
    return kept.groupBy("source").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n_new").alias("productive"), F.max("page").alias("last_page")
    )


@check(
    "b9_cap",
    f"WITH {LINKS_SQL} SELECT source, page, CAST(pos AS INT) AS pos, url FROM fresh ORDER BY page, pos, source LIMIT {V.RUN_CAP_FLAT_B}",
)
def _(spark, sf_dir):
    return R.cap(fresh_links(listing_links(spark, sf_dir)), V.RUN_CAP_FLAT_B, ["page", "pos", "source"])


@check(
    "b10_assign_batches",
    f"""WITH {LINKS_SQL} SELECT source, page, CAST(pos AS INT) AS pos, url,
      (row_number() OVER (ORDER BY page, pos, source) - 1) // {V.BATCH_SIZE_FLAT_B} AS batch_no FROM fresh""",
)
def _(spark, sf_dir):
    fresh = fresh_links(listing_links(spark, sf_dir))
    return R.assign_batches(fresh, V.BATCH_SIZE_FLAT_B, ["page", "pos", "source"])


OUTCOMES_SQL = """
fetches AS (SELECT event_id, 'https://host/jobs/p/' || CAST(event_id // 2 AS STRING) AS url,
  CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 200 WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 404 ELSE 410 END
    WHEN 'error' THEN 500 END AS status,
  CASE event_type WHEN 'click' THEN 'no_details_extracted' WHEN 'signup' THEN 'Timeout: ' || repeat(props, 12) END AS error
  , ts FROM events),
outcomes AS (SELECT *, CASE WHEN status IN (404, 410) OR error = 'no_details_extracted' THEN 'gone'
  WHEN status = 200 AND error IS NULL THEN 'ok' ELSE 'retry' END AS outcome FROM fetches),
known_before AS (SELECT DISTINCT url FROM fetches WHERE ts < TIMESTAMP '2024-01-05')"""


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_type")
    gone = F.when(F.col("event_id") % 2 == 0, 404).otherwise(410)
    fetches = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.concat(F.lit("https://host/jobs/p/"), F.floor(F.col("event_id") / 2).cast("string")).alias("url"),
        F.when(event.isin("view", "click"), 200).when(event == "purchase", gone).when(event == "error", 500).alias("status"),
        F.when(event == "click", V.GONE_ERROR)
        .when(event == "signup", F.concat(F.lit("Timeout: "), F.repeat("props", F.lit(12))))
        .alias("error"),
    )
    return fetches.withColumn("outcome", R.classify_outcome(F.col("status"), F.col("error")))


def known_before(fetched: DataFrame) -> DataFrame:
    return fetched.filter(F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz")).select("url").distinct()


@check("b11_classify_outcome", f"WITH {OUTCOMES_SQL} SELECT event_id, outcome FROM outcomes")
def _(spark, sf_dir):
    return outcomes(spark, sf_dir).select("event_id", "outcome")


@check(
    "b12_advance_checkpoint",
    f"WITH {OUTCOMES_SQL} SELECT url FROM known_before UNION SELECT url FROM outcomes WHERE outcome IN ('ok', 'gone')",
)
def _(spark, sf_dir):
    fetched = outcomes(spark, sf_dir)
    return R.advance_checkpoint(known_before(fetched), fetched)


@check(
    "b13_failed_records",
    f"""WITH {OUTCOMES_SQL} SELECT url, '{STAMP}' AS attempted_at,
      CASE WHEN error = 'no_details_extracted' THEN 'gone_no_details' WHEN error IS NOT NULL THEN left(error, 100)
           ELSE 'http_' || CAST(status AS STRING) END AS reason
      FROM outcomes WHERE outcome = 'retry' OR error = 'no_details_extracted'""",
)
def _(spark, sf_dir):
    return R.failed_records(outcomes(spark, sf_dir), STAMP)


@check(
    "b14_run_summary",
    f"""WITH {OUTCOMES_SQL}, after AS (SELECT url FROM known_before UNION SELECT url FROM outcomes WHERE outcome IN ('ok', 'gone'))
      SELECT outcome AS metric, count(*) AS n FROM outcomes GROUP BY outcome
      UNION ALL SELECT 'checkpoint_total', count(*) FROM after""",
)
def _(spark, sf_dir):
    fetched = outcomes(spark, sf_dir)
    return R.run_summary(fetched, R.advance_checkpoint(known_before(fetched), fetched))


@check(
    "b15_checkpoint_orphans",
    f"""WITH {OUTCOMES_SQL}, after AS (SELECT url FROM known_before UNION SELECT url FROM outcomes WHERE outcome IN ('ok', 'gone'))
      SELECT url FROM after WHERE url NOT IN (SELECT url FROM outcomes WHERE outcome = 'ok')""",
)
def _(spark, sf_dir):
    fetched = outcomes(spark, sf_dir)
    stored = fetched.filter(F.col("outcome") == "ok")
    return R.checkpoint_orphans(R.advance_checkpoint(known_before(fetched), fetched), stored)


# --- pages -> records ---------------------------------------------------------------------------


@check(
    "c1_embedded_json",
    """SELECT page_id, CAST(page_id AS STRING) AS id, url || '"}{' AS note, CAST(length(html) AS STRING) AS inner_n FROM pages""",
)
def _(spark, sf_dir):
    """A script assignment amid the page's own text, with braces and quotes inside its strings."""
    pages = table(spark, sf_dir, "pages")
    state = F.to_json(
        F.struct(
            F.col("page_id").alias("id"),
            F.concat("url", F.lit('"}{')).alias("note"),
            F.struct(F.length("html").alias("n")).alias("inner"),
        )
    )
    body = F.concat(F.lit("<script>if (App.state) { go({}) } App.state = "), state, F.lit(";\n</script>}"), "html")
    found = pages.select("page_id", X.extract_embedded_json(body, "App.state").alias("j"))
    return found.select(
        "page_id",
        F.get_json_object("j", "$.id").alias("id"),
        F.get_json_object("j", "$.note").alias("note"),
        F.get_json_object("j", "$.inner.n").alias("inner_n"),
    )


@check(
    "c1_embedded_json_escaped",
    """SELECT page_id, CAST(page_id AS STRING) AS id, 'Cook "A" {1}' AS title, 1 AS has_all FROM pages""",
)
def _(spark, sf_dir):
    """The same inside a JavaScript string, one level of escapes deeper; marker inside the object."""
    pages = table(spark, sf_dir, "pages")
    plain = F.to_json(
        F.struct(
            F.col("page_id").alias("id"),
            F.lit('Cook "A" {1}').alias("jobPositionValue"),
            F.struct("url").alias("where"),
        )
    )
    escaped = F.replace(F.replace(plain, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    body = F.concat("html", F.lit('push("{\\"other\\":{\\"x\\":1}},'), escaped, F.lit(',{\\"tail\\":2}")'))
    j = X.extract_embedded_json(body, V.ESCAPED_MARKER, V.ESCAPED_OPENER, escaped=True)
    found = pages.select("page_id", "url", j.alias("j"))
    return found.select(
        "page_id",
        F.get_json_object("j", "$.id").alias("id"),
        F.get_json_object("j", "$.jobPositionValue").alias("title"),
        (F.get_json_object("j", "$.where.url") == F.col("url")).cast("int").alias("has_all"),
    )


def _state_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting pages whose script holds two postings and their companies."""
    k = F.col("o_orderkey")
    orders = spread(table(spark, sf_dir, "orders")).select(k.alias("k"), F.col("o_custkey").alias("c"), "o_orderpriority")
    own, other = F.col("k").cast("string"), (F.col("k") + 1).cast("string")

    def job(ident, title):
        company = F.when(F.col("k") % 4 > 0, F.col("c").cast("string"))
        return F.struct(
            F.struct(title.alias("title"), F.concat(F.lit("s-"), ident).alias("slug")).alias("attributes"),
            F.struct(F.struct(F.struct(company.alias("id")).alias("data")).alias("company")).alias("relationships"),
        )

    jobs = F.create_map(other, job(other, F.lit("other")), own, job(own, F.col("o_orderpriority")))
    companies = F.create_map(
        F.col("c").cast("string"),
        F.struct(F.struct(F.concat(F.lit("Company "), F.col("c").cast("string")).alias("name")).alias("attributes")),
    )
    similar = F.when(F.col("k") % 3 == 1, F.create_map(own, F.lit("x")))
    store = F.struct(
        F.struct(F.struct(jobs.alias("collection")).alias("job"), F.struct(companies.alias("collection")).alias("company")).alias("entities"),
        F.struct(similar.alias("similarJobs")).alias("jobPage"),
    )
    slug = F.when(F.col("k") % 3 == 0, F.concat(F.lit("s-"), own)).otherwise(F.lit("gone"))
    return orders.select(
        "k",
        F.concat(F.lit("https://host/jobs/p/"), slug, F.lit("?q="), own).alias("url"),
        F.concat(F.lit(f"<p>x</p><script>{V.STATE_MARKER} = "), F.to_json(store), F.lit(";\n</script>")).alias("html"),
    )


@check(
    "c2_pick_entity",
    """SELECT o_orderkey AS k, CAST(CASE WHEN o_orderkey % 3 < 2 THEN o_orderkey ELSE o_orderkey + 1 END AS STRING) AS picked,
       CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority ELSE 'other' END AS title FROM orders""",
)
def _(spark, sf_dir):
    pages = _state_pages(spark, sf_dir).select("k", "url", X.page_state(F.col("html")).alias("store"))
    job = pages.select("k", X.pick_entity(F.col("store"), F.col("url")).alias("job"))
    return job.select("k", F.col("job.key").alias("picked"), F.col("job.value.attributes.title").alias("title"))


@check(
    "c3_lookup_entity",
    """SELECT substr(sha1(CASE WHEN o_orderkey % 3 = 0 THEN 's-' || CAST(o_orderkey AS STRING) ELSE 'gone' END), 1, 12) AS job_id,
       'https://host/jobs/p/' || CASE WHEN o_orderkey % 3 = 0 THEN 's-' || CAST(o_orderkey AS STRING) ELSE 'gone' END
         || '?q=' || CAST(o_orderkey AS STRING) AS job_url,
       CASE WHEN o_orderkey % 4 > 0 THEN 'Company ' || CAST(o_custkey AS STRING) END AS company FROM orders""",
)
def _(spark, sf_dir):
    records = X.nested_records(_state_pages(spark, sf_dir), STAMP, "b1")
    return records.select("job_id", "job_url", F.col("company_attributes.name").alias("company"))


@check(
    "c4_slug_id",
    f"""{Q.WITH_RAW} SELECT k, substr(sha1(coalesce(nullif(regexp_extract(raw_job_url, '/jobs/p/([^/?]+)', 1), ''), raw_job_url)), 1, 12) AS id FROM raw""",
)
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", slug_id(F.col("raw_job_url")).alias("id"))


@check(
    "c5_extract_fields",
    """SELECT page_id, replace(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '&amp;', '&') AS title,
         replace(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), '&amp;', '&') AS h1,
         array_to_string(regexp_extract_all(html, '<li><a\\s[^>]*href="([^"]*)"', 1), ' ') AS nav,
         array_to_string(list_transform(regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1), lambda x: trim(x)), ' | ') AS ads
       FROM pages""",
)
def _(spark, sf_dir):
    spec = {
        "title": X.FieldSpec(["title"]),
        "h1": X.FieldSpec(["article h1"]),
        "nav": X.FieldSpec(["nav ul li a"], attribute="href"),
        "ads": X.FieldSpec(["div.ad"]),
    }
    read = X.extract_fields(spread(table(spark, sf_dir, "pages").select("page_id", "html")), "html", spec)
    first = lambda name: F.coalesce(F.try_element_at(F.col(f"fields.{name}"), F.lit(1)), F.lit(""))
    return read.select(
        "page_id",
        first("title").alias("title"),
        first("h1").alias("h1"),
        F.array_join("fields.nav", " ").alias("nav"),
        F.array_join("fields.ads", " | ").alias("ads"),
    )


@check(
    "c6_classify_tags",
    f"""{Q.WITH_RAW} SELECT k, CASE WHEN raw_work_mode IN ('Hybrid', 'On-site') AND k % 2 = 0 THEN raw_work_mode ELSE 'REMOTE' END AS mode,
         CASE WHEN raw_employment_type IN ('Contract', 'INTERNSHIP', 'freelance', 'Temporary', 'Full Time') THEN raw_employment_type END AS kind FROM raw""",
)
def _(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    tags = F.array(
        F.when(F.col("k") % 2 == 0, F.lit("REMOTE")).otherwise(F.col("raw_work_mode")),
        F.col("raw_employment_type"),
        F.when(F.col("k") % 2 == 0, F.col("raw_work_mode")).otherwise(F.lit("REMOTE")),
    )
    return raw.select(
        "k",
        classify_tags(tags, V.TAG_WORK_MODES).alias("mode"),
        classify_tags(tags, V.TAG_JOB_TYPES).alias("kind"),
    )


@check(
    "c7_kv_map",
    """SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'late' ELSE o_orderpriority END AS salary,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS status FROM orders""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    last = F.when(F.col("o_orderstatus") == "F", F.lit("late")).otherwise(F.col("o_orderpriority"))
    details = kv_map(
        F.array(F.lit("Salary"), F.col("o_orderstatus"), F.lit(None).cast("string"), F.lit("Salary")),
        F.array(F.lit("early"), F.col("o_orderpriority"), F.lit("x"), last),
    )
    return orders.select(
        F.col("o_orderkey").alias("k"),
        F.try_element_at(details, F.lit("Salary")).alias("salary"),
        F.try_element_at(details, F.lit("F")).alias("status"),
    )


@check(
    "c8_join_list",
    f"""{Q.WITH_RAW} SELECT k, nullif(array_to_string(list_filter([raw_skills, raw_company_name, raw_work_mode],
       lambda x: x IS NOT NULL AND trim(x) <> ''), '; '), '') AS joined FROM raw""",
)
def _(spark, sf_dir):
    items = F.array("raw_skills", "raw_company_name", "raw_work_mode")
    return raw_postings(spark, sf_dir).select("k", join_list(items).alias("joined"))


@check(
    "c9_project_fields",
    f"""{Q.WITH_RAW} SELECT k, raw_job_id AS id, raw_job_title AS title, trim(coalesce(raw_company_name, '')) AS company,
       CASE WHEN k % 3 = 0 THEN '' ELSE raw_job_id || ', x' END AS industries FROM raw""",
)
def _(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    record = F.struct(
        F.col("raw_job_id").alias("ident"),
        F.col("raw_job_title").alias("jobPositionValue"),
        F.col("raw_company_name").alias("partnerName"),
        F.when(F.col("k") % 3 > 0, F.array(F.col("raw_job_id"), F.lit("x"))).alias("industries"),
    )
    spec = {"id": "ident", "title": "jobPositionValue", "company": "partnerName", "industries": "industries"}
    return X.project_fields(raw.select("k", record.alias("r")), "r", spec, ["industries"], ["company"])


@check(
    "c10_lenient_iso",
    f"""{Q.WITH_RAW} SELECT k, CASE WHEN contains(raw_posted_date, 'T') THEN raw_posted_date
         WHEN {Q.parse_ts('raw_posted_date')} IS NULL THEN raw_posted_date
         ELSE replace({Q.parse_ts('raw_posted_date')}, ' ', 'T') END AS iso FROM raw""",
)
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", lenient_iso(F.col("raw_posted_date")).alias("iso"))
