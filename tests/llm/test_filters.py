"""Quality, line dedup, archives, URL lists, the pipeline, and the SQL twins."""

import gzip
import hashlib
import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from vacancia.llm import line_dedup, quality, queries, url_filters, warc


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_twin(spark, sf, name):
    equal, note = compare(spark, connect(sf), sf, queries.QUERIES[name], queries.ORACLES[name])
    assert equal, note


def test_lines(spark):
    rows = [(i, "h", f"top\nown text {i}\n\nfoot") for i in range(40)] + [(90, "h", "top"), (91, None, "top"), (92, "h", None), (93, "h", "")]
    rows += [(100 + i, "small", f"top\ntext of page {i}") for i in range(2)] + [(110, "one", "top\nx")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n_chars", F.length("text"))
    docs = docs.withColumns({name: F.lit(name) for name in ("keys", "page", "host", "row", "line", "parts", "new")})
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs, length="n_chars").collect()}
    assert out[3].text == "own text 3\n" and out[3].n_chars == 11 and out[3]["keys"] == "keys" and len(out[3]) == len(docs.columns)
    assert (out[90].text, out[91].text, out[92].text, out[93].text) == ("", "top", None, "")
    assert [out[100 + i].text for i in range(2)] == ["text of page 0", "text of page 1"]  # on all pages of a small host
    assert out[110].text == "top\nx"
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_lines_by_length(spark):
    """Long lines go from a small share of the pages on; whole texts that repeat stay."""
    long, licence, short = "a long passage " * 7, "Licensed under CC BY-NC 4.0.", "And."
    on = {long: 4, "an other long passage " * 5: 2, licence: 6, short: 13, "The.": 12}
    own = "some words of its own that stand on this page and on no other one of the site, number {} of many " * 4
    rows = [(i, "h", "\n".join([own.format(*[i] * 4), *(x for x, n in on.items() if i < n)])) for i in range(500)]
    rows += [(1000 + i, "small", f"page number {i}\nfoot") for i in range(3)] + [(1010 + i, "copies", "same\ntext") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    tail = lambda i: out[i].split("\n")[1:]
    assert tail(0) == ["an other long passage " * 5, "The."]  # on too few pages for their length
    assert tail(5) == ["The."] and tail(12) == []
    assert [out[1000 + i] for i in range(3)] == [f"page number {i}" for i in range(3)]
    assert all(out[1010 + i] == "same\ntext" for i in range(9))


@pytest.mark.parametrize("others", [0, 2, 4, 500])
@pytest.mark.parametrize("copies", [2, 3, 40])
def test_near_copies_count_once(spark, others, copies):
    """An article with other last lines keeps its text on hosts of any size; footers around it go."""
    article = "\n".join(f"line {k} of the article, which is copied with small changes" for k in range(20))
    rows = [(i, "h", f"{article}\nposted at 10:{i:02d}\nAll rights reserved by the owners of this site.") for i in range(copies)]
    rows += [(100 + i, "h", f"page {i} has a text of its own\nand a second line {i} " * 3 + "\nAll rights reserved by the owners of this site.") for i in range(others)]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert all(out[i].startswith(f"{article}\nposted at 10:{i:02d}") for i in range(copies))
    assert [i for i in out if "rights" in out[i]] == ([] if others else list(range(copies)))


def test_archive(spark):
    long = "x" * 120
    rows = [(3, "u3", long), (1, "u1", long), (1, "u1", long), (None, "u", long), (5, None, "short"), (6, "a\r\nb", "short"), (7, "u", None), (8, "u", "é" * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    folder = warc.write_archive(pages)
    records = warc.read_archive(spark, folder)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.describe(records).collect()), key=repr)
    want = [(3, 120, "revisit", 1), (1, 120, "response", None), (1, 120, "response", None), (None, 120, "revisit", 1)]
    want += [(5, 5, "response", None), (6, 5, "response", None), (7, 0, "response", None), (8, 120, "response", None)]
    assert got == sorted(want, key=repr)
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    whole = {}
    for r in [*spark.read.parquet(f"{folder}/payloads").collect(), *spark.read.parquet(f"{folder}/others").collect()]:
        with open(r.path.removeprefix("file:"), "rb") as file:
            file.seek(r.offset)
            whole[r.page_id] = gzip.decompress(file.read(r.length))
    date = re.search(rb"WARC-Date: (\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ)\r\n", whole[6]).group(1)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    assert whole[6] == (
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:6>\r\nWARC-Date: " + date + b"\r\nWARC-Target-URI: a%0D%0Ab\r\n"
        b"WARC-Payload-Digest: sha256:" + hashlib.sha256(b"short").hexdigest().encode() + b"\r\nContent-Type: application/http; msgtype=response\r\n"
        b"Content-Length: " + str(len(http) + 5).encode() + b"\r\n\r\n" + http + b"short\r\n\r\n"
    )
    assert whole[3].endswith(b"\r\n\r\n" + http + b"\r\n\r\n") and b"xxx" not in whole[3]
    assert b"WARC-Refers-To: <urn:page:1>\r\nWARC-Profile: http" in whole[3] and b"WARC-Target-URI: urn:page:5\r\n" in whole[5]
    assert warc.describe(warc.read_archive(spark, warc.write_archive(pages.limit(0)))).count() == 0
    dated = pages.withColumn("at", F.expr("if(page_id = 7, timestamp'2024-02-03 04:05:06', null)"))
    heads = {r.page_id: r.header for r in warc.read_archive(spark, warc.write_archive(dated, date="at")).collect()}
    assert "WARC-Date: 2024-02-03T04:05:06Z\r\n" in heads[7] and "WARC-Date: 20" in heads[8]


@pytest.mark.parametrize("file_bytes", [1, 1 << 30])
def test_archive_files(spark, file_bytes):
    """Read as plain streams, the files are the whole crawl: one record a row, each payload once."""
    copy = "ä\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(i, f"http://h/{i}", copy) for i in range(30)] + [(40, None, None), (41, "", "x"), (43, "", "x"), (None, "u", copy), (42, "u", "long " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "77")
    folder = warc.write_archive(pages, file_bytes=file_bytes)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "77"
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    records = {r.page_id: (r.header, bytes(r.payload)) for r in warc.read_archive(spark, folder).collect()}
    assert {k: p for k, (_, p) in records.items()} == {k: (h or "").encode() for k, _, h in rows}
    listed = [*spark.read.parquet(f"{folder}/payloads").collect(), *spark.read.parquet(f"{folder}/others").collect()]
    paths = {r.path for r in listed}
    assert len(listed) == len(rows) and (len(paths) == len(rows) if file_bytes == 1 else len(paths) < len(rows))
    plain, found = b"".join(gzip.open(p.removeprefix("file:")).read() for p in sorted(paths)), {}
    while plain:  # as any reader of the format: header, then as many bytes as it says, then two line ends
        header, _, rest = plain.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)$", header).group(1))
        name = re.search(rb"Record-ID: <urn:page:(\w+)>", header).group(1)
        assert rest[size : size + 4] == b"\r\n\r\n"
        found[None if name == b"unknown" else int(name)] = header.decode() + "\r\n\r\n", rest[:size].partition(b"\r\n\r\n")[2]
        plain = rest[size + 4 :]
    assert {k: h for k, (h, _) in found.items()} == {k: h for k, (h, _) in records.items()}
    assert all(p == (b"" if "revisit" in h else records[k][1]) for k, (h, p) in found.items())
    first = next(r for r in listed if r.page_id == 0)
    with open(first.path.removeprefix("file:"), "r+b") as file:
        file.seek(first.offset + first.length - 12)
        file.write(b"damaged")
    with pytest.raises(Exception, match="CRC|damaged|decompress|Error"):
        warc.read_archive(spark, folder).collect()


def test_url_lists(spark):
    log = [("bad.example.org", "block", date(2024, 1, 10)), ("bad.example.org", "remove", date(2024, 2, 1)), ("bad.example.org", "block", date(2024, 3, 1))]
    log += [("example.org", "allow", date(2024, 1, 1)), ("x.org", "block", date(2024, 1, 1)), ("x.org", "allow", date(2024, 1, 1)), ("a.x.org/ok", "allow", date(2024, 1, 5)), (None, "block", date(2024, 1, 1)), ("y.org", "block", None)]
    log = spark.createDataFrame(log, "entry string, action string, listed_on date")
    bad, ok = "https://Bad.Example.org:80/p?q", "http://u@a.x.org/ok/page"
    rows = [(1, bad, date(2024, 1, 9)), (2, bad, date(2024, 1, 10)), (3, bad, date(2024, 2, 1)), (4, bad, date(2024, 3, 2)), (4, bad, date(2024, 3, 2))]
    rows += [(5, ok, date(2024, 1, 4)), (6, ok, date(2024, 1, 5)), (7, "http://y.org", date(2025, 1, 1)), (8, None, date(2024, 1, 1)), (9, bad, None), (10, "no url", date(2024, 1, 1)), (None, bad, date(2024, 1, 10))]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_on date").withColumn("listed", F.lit(0))
    got = [(r.page_id, r.blocked, r.entry) for r in url_filters.filter_captures(captures, log).collect()]
    want = [(1, False, "example.org"), (2, True, "bad.example.org"), (3, False, "example.org"), (4, True, "bad.example.org"), (4, True, "bad.example.org")]
    want += [(5, True, "x.org"), (6, False, "a.x.org/ok"), (7, False, None), (8, False, None), (9, False, None), (10, False, None), (None, True, "bad.example.org")]
    assert Counter(got) == Counter(want)
    assert url_filters.filter_captures(captures.limit(0), log).count() == 0
    assert url_filters.filter_captures(captures, log.limit(0)).filter("blocked").count() == 0


def test_native_plans_run_no_python(spark, sf):
    for name in ("op5_line_dedup", "op10_url_filters"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_quality_on_held_out_labels(spark):
    """Fit on labels of even keys, judge odd ones."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.filter("doc_id % 2 = 0"))
    kept = quality.keep_good(quality.score(docs, model))
    assert kept.columns == docs.columns
    kept = {r.doc_id for r in kept.select("doc_id").collect()}
    held = labels.filter("doc_id % 2 = 1").collect()
    good, junk = [r.doc_id in kept for r in held if r.quality], [r.doc_id in kept for r in held if not r.quality]
    assert sum(good) >= 0.98 * len(good) and sum(junk) <= 0.1 * len(junk)


def test_quality_of_odd_rows(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (8, None), (1, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    kept = quality.keep_good(quality.score(docs, model))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 8, 9, 10, 11, 12, 12, 13]  # those with words
    assert quality.score(empty, quality.train(empty, labels)).count() == 0


def test_sparse_sites_are_shrunk(spark):
    """A site's bad mean counts for a large site, hardly for a small one."""
    rows = [(i, "big", "p", "junk" if i % 20 else "fine") for i in range(400)]
    rows += [(1000 + i, f"s{i % 50}", "p", "fine" if i // 50 % 10 < 7 else "junk") for i in range(1000)]
    rows += [(2000, "tiny", "p", "junk"), (2001, "tiny", "p", "fine")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")

    class Fixed:
        def probabilities(self, bodies):
            import numpy as np

            return np.array([0.6 if b == b"fine" else 0.05 for b in bodies])

    out = {r.row.doc_id: r for r in quality.score(docs, Fixed()).collect()}
    assert out[0].posterior < 0.3 < 0.4 < out[2001].posterior
    assert abs(out[2001].path_mean - out[1000].path_mean) < 0.25 < out[1000].path_mean - out[0].path_mean


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        got = stage(spark, docs, sf)
        assert got.columns == first.columns and got.schema.simpleString() == first.schema.simpleString(), name
        docs = got
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
