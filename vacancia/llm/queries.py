"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vacancia.llm.common import table

RANKS, LIBRARY = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.token_files import read, write

    return read(spark, write(table(spark, sf_dir, "documents"), public_tokenizers.path(LIBRARY), end_id=2))


@query
def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(LIBRARY), end_id=0, size=2048)


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op8_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.line_dedup import dedup_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return dedup_lines(docs, dropped="n_dropped")


ORACLES["op5_line_dedup"] = """
WITH pages AS (
  SELECT row_number() OVER () AS page, source AS host,
         list_filter(list_distinct(string_split(coalesce(text, ''), chr(10))), lambda x: trim(x) <> '') AS lines
  FROM documents WHERE source IS NOT NULL
), laid AS (
  SELECT page, host, CAST(list_sum(list_transform(lines, lambda x: length(x))) AS BIGINT) AS total, unnest(lines) AS line FROM pages
), counts AS (SELECT host, line, count(*) AS n FROM laid GROUP BY ALL HAVING count(*) >= 2),
shared AS (SELECT laid.*, n FROM laid JOIN counts USING (host, line)),
by_n AS (SELECT page, total, n, sum(length(line)) AS chars FROM shared GROUP BY ALL),
parts AS (
  SELECT page, 720720 // max(n) AS parts
  FROM (SELECT *, sum(chars) OVER (PARTITION BY page ORDER BY n DESC) AS up_to FROM by_n) WHERE 2 * up_to >= total GROUP BY page
), totals AS (SELECT host, sum(coalesce(parts, 720720)) AS pages FROM pages LEFT JOIN parts USING (page) GROUP BY host),
found AS (
  SELECT host, line FROM (
    SELECT host, line, sum(coalesce(parts, 720720)) AS with_line FROM shared LEFT JOIN parts USING (page) GROUP BY ALL) JOIN totals USING (host)
  WHERE (with_line - 2 * 720720) * 50 * greatest(length(line), 10) > 10 * pages OR (with_line = pages AND 2 * pages > 3 * 720720)
), lists AS (SELECT host AS source, list(line) AS gone FROM found GROUP BY host),
kept AS (
  SELECT doc_id, source, text, gone,
         list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(gone, x)) AS stay
  FROM documents LEFT JOIN lists USING (source)
)
SELECT doc_id, source, CASE WHEN gone IS NULL OR text IS NULL THEN text ELSE array_to_string(stay, chr(10)) END AS text,
       CASE WHEN gone IS NULL OR text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) - len(stay) END AS n_dropped
FROM kept
"""


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.warc import describe, read_archive, write_archive

    return describe(read_archive(spark, write_archive(table(spark, sf_dir, "pages"))))


ORACLES["op6_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages),
o AS (SELECT digest, min(page_id) AS owner FROM p GROUP BY digest)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN bytes >= 100 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 100 AND page_id <> owner THEN owner END AS refers_to
FROM p JOIN o USING (digest)
"""


def capture_log(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures with fetch dates, and a dated list, both derived from the pages.

    A page is fetched on a day of 2024 that follows from its id. Every host, its parent and the host
    with its first path segment may be listed; the MD5 of an entry says whether, from when, for how
    long, and whether it comes back.
    """
    from pyspark.sql import functions as F

    from vacancia.llm.url_filters import keys_of

    start = F.to_date(F.lit("2024-01-01"))
    captures = pages.select("page_id", "url", F.date_add(start, (F.col("page_id") * 37 % 366).cast("int")).alias("fetched_on"))
    entries = pages.select(F.explode(F.array_distinct(keys_of(F.col("url")))).alias("entry")).filter("entry LIKE '%.%.%'").distinct()
    byte = lambda i: F.conv(F.substring(F.md5("entry"), 2 * i + 1, 2), 16, 10).cast("int")
    begin = F.date_add(start, byte(1))
    chosen = (byte(0) < 48) | F.col("entry").rlike("spam|pills|casino")
    first = F.when(byte(0) % 4 == 0, "allow").otherwise("block")
    log = entries.filter(chosen).select(
        "entry",
        F.explode(
            F.array(
                F.struct(first.alias("action"), begin.alias("listed_on")),
                F.struct(F.lit("remove").alias("action"), F.date_add(begin, byte(2) % 100 + 10).alias("listed_on")),
                F.struct(F.lit("block").alias("action"), F.date_add(begin, byte(3) % 100 + 110).alias("listed_on")),
            )
        ).alias("change"),
    )
    return captures, log.select("entry", "change.action", "change.listed_on")


@query
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.url_filters import filter_captures

    captures, log = capture_log(table(spark, sf_dir, "pages"))
    return filter_captures(captures, log)


_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
_SEGMENT = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1)"
ORACLES["op10_url_filters"] = f"""
WITH c AS (
  SELECT page_id, url, nullif({_HOST}, '') AS host, nullif({_SEGMENT}, '') AS seg,
         CAST(DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS DATE) AS fetched_on FROM pages
), k AS (
  SELECT page_id, host, fetched_on, unnest(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))
    || CASE WHEN seg IS NULL THEN [] ELSE [host || '/' || seg] END) AS entry
  FROM c WHERE host IS NOT NULL
), e AS (
  SELECT DISTINCT entry, CAST('0x' || substr(md5(entry), 1, 2) AS INTEGER) AS b0, CAST('0x' || substr(md5(entry), 3, 2) AS INTEGER) AS b1,
         CAST('0x' || substr(md5(entry), 5, 2) AS INTEGER) AS b2, CAST('0x' || substr(md5(entry), 7, 2) AS INTEGER) AS b3
  FROM k WHERE entry LIKE '%.%.%'
), v AS (
  SELECT entry, CASE WHEN b0 % 4 = 0 THEN 'allow' ELSE 'block' END AS action, DATE '2024-01-01' + b1 AS valid_from,
         DATE '2024-01-01' + b1 + (b2 % 100 + 10) AS valid_to FROM e WHERE b0 < 48 OR regexp_matches(entry, 'spam|pills|casino')
  UNION ALL
  SELECT entry, 'block', DATE '2024-01-01' + b1 + (b3 % 100 + 110), NULL FROM e WHERE b0 < 48 OR regexp_matches(entry, 'spam|pills|casino')
), m AS (
  SELECT page_id, v.* , row_number() OVER (PARTITION BY page_id ORDER BY length(v.entry) DESC) AS r
  FROM k JOIN v ON k.entry = v.entry AND fetched_on >= valid_from AND (valid_to IS NULL OR fetched_on < valid_to)
)
SELECT c.page_id, c.host, c.fetched_on, coalesce(m.action = 'block', false) AS blocked, m.entry, m.action, m.valid_from AS listed_on
FROM c LEFT JOIN m ON c.page_id = m.page_id AND m.r = 1
"""


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from vacancia.llm.quality import THRESHOLD, score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    kept = (F.col("posterior") >= THRESHOLD).alias("kept")
    return scored.select("row.doc_id", "row.source", "row.lang", "p", "host_mean", "path_mean", "posterior", kept)


@query
def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.fingerprints import compare_neighbours

    return compare_neighbours(table(spark, sf_dir, "documents"))


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.ngram_join import similar_documents

    return similar_documents(table(spark, sf_dir, "documents"))


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.spelling import spelling_groups

    return spelling_groups(table(spark, sf_dir, "documents"))


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vacancia.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))
