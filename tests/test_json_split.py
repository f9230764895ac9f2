"""Array files in any layout, in blocks that cut records and strings apart."""

import json

import pytest
from pyspark.sql import functions as F

from vacancia import schemas as S
from vacancia.sources import json_split as J
from vacancia.sources import landing as L


def record(i):
    return {
        "id": i, "title": f'T "{i}" }},{{ \\ x\\', "url": f"u{i}", "description": "é" * (i % 7) + "]}[{" * (i % 5),
        "nest": [{"id": 1}, {"id": 2}],
    }


RECORDS = [record(i) for i in range(200)]
PLAIN = json.dumps(RECORDS)


@pytest.fixture(scope="module")
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def put(folder, name, text):
    (folder / name).write_bytes(text.encode())


def read(spark, folder):
    """name -> (ids, distinct ids, unreadable pieces), and the names of files that were cut off."""
    pieces = L.read_pieces(spark, f"{folder}/*.json")
    name = F.regexp_extract("_source_file", r"([^/]+)\.json$", 1).alias("name")
    rows = L.parse_pieces(pieces, S.RAW_FLAT_B).groupBy(name)
    rows = rows.agg(F.count("id").alias("ids"), F.count_distinct("id").alias("kinds"), F.count("_corrupt_record").alias("bad"))
    cut = {r[0] for r in L.cut_off_files(pieces).select(name).collect()}
    return {r["name"]: (r["ids"], r["kinds"], r["bad"]) for r in rows.collect()}, cut


def test_layouts(spark, small_blocks, tmp_path):
    layouts = {
        "spaced": PLAIN, "compact": json.dumps(RECORDS, separators=(",", ":"), ensure_ascii=False),
        "crlf": json.dumps(RECORDS, indent=2).replace("\n", "\r\n"), "tabs": json.dumps(RECORDS, indent="\t"),
        "indented": json.dumps(RECORDS, indent=2), "mark": "﻿" + PLAIN,
    }
    for name, text in layouts.items():
        put(tmp_path, f"{name}.json", text)
    assert read(spark, tmp_path) == ({name: (200, 200, 0) for name in layouts}, set())
    rows = L.read_postings(spark, f"{tmp_path}/compact.json", S.RAW_FLAT_B)
    assert rows.rdd.getNumPartitions() > 5
    got = sorted((r["id"], r["title"], r["description"]) for r in rows.collect())
    assert got == sorted((str(r["id"]), r["title"], r["description"]) for r in RECORDS)


def test_one_bad_record_costs_one_record(spark, small_blocks, tmp_path):
    nest = '"nest": [{"id": 1}, {"id": 2}]}'
    put(tmp_path, "word.json", PLAIN.replace('"id": 5,', '"id": broken,', 1))
    put(tmp_path, "quote.json", PLAIN.replace('"url": "u100"', '"url": "u100', 1))
    put(tmp_path, "open.json", PLAIN.replace(nest, nest[:-2], 1))
    put(tmp_path, "closed.json", PLAIN.replace(nest, nest + "}", 1))
    put(tmp_path, "cut.json", PLAIN[: PLAIN.index('"url": "u150"')])
    put(tmp_path, "other.json", '[1, {"id": 1}, "x", null, {"id": 2}]')
    found, cut = read(spark, tmp_path)
    assert found == {
        "word": (199, 199, 1), "quote": (199, 199, 1), "open": (199, 199, 1), "closed": (200, 200, 1),
        "cut": (150, 150, 1), "other": (2, 2, 2),
    }
    assert cut == {"cut"}


def test_odd_files(spark, small_blocks, tmp_path):
    long = [{"id": 1, "title": "x" * 20000}, {"id": 2, "title": "}" * 20000}, {"id": 3}]
    put(tmp_path, "long.json", json.dumps(long))
    put(tmp_path, "empty.json", "[]")
    put(tmp_path, "blank.json", " \n ")
    put(tmp_path, "nothing.json", "")
    put(tmp_path, "object.json", '{"id": 77}')
    put(tmp_path, "a b[1].json", '[{"id": 1}]')
    assert read(spark, tmp_path) == ({"long": (3, 3, 0), "object": (1, 1, 0), "a%20b%5B1%5D": (1, 1, 0)}, set())
    rows = L.read_postings(spark, f"{tmp_path}/long.json", S.RAW_FLAT_B).collect()
    assert sorted((r["id"], len(r["title"] or "")) for r in rows) == [("1", 20000), ("2", 20000), ("3", 0)]


def test_effects_compose():
    """What a text does is what its parts do one after the other, wherever it is cut behind a brace."""
    text = PLAIN[:3000].encode()
    whole = J._Effect()
    whole.add(text, None)
    for cut in [i + 1 for i, c in enumerate(text) if c == ord("}")]:
        parts = J._Effect()
        parts.add(text[:cut], None)
        parts.add(text[cut:], None)
        assert parts.row() == whole.row()


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_any_number_of_files(spark, tmp_path):
    """Names of files stand in no expression, and a file costs no group of its own."""
    names = [f"file{i:03d}" for i in range(60)]
    for i, name in enumerate(names):
        records = [{"id": f"{i}-{k}", "title": "t"} for k in range(3)]
        text = json.dumps(records) if i % 2 else json.dumps(records, indent=2)
        put(tmp_path, f"{name}.json", text.replace('"id": "5-1"', '"id": "5-1'))
    pieces = L.read_pieces(spark, f"{tmp_path}/*.json")
    assert not any(name in plan_of(pieces) for name in names)
    assert "InPandas" not in plan_of(J._starts(J._effects(J.fragments(spark, f"{tmp_path}/*.json"))))
    rows = L.parse_pieces(pieces, S.RAW_FLAT_B)
    assert rows.filter("id IS NOT NULL").count() == 179 and rows.filter("_corrupt_record IS NOT NULL").count() == 1


def test_certain_beginnings_in_one_scan():
    """A chunk with many beginnings that are certain is what its parts are one after the other."""
    text = (PLAIN.replace('"url": "u7"', '"url": "u7').replace('"url": "u9"', '"url": "u9", "x": {')).encode()
    marker = J._marker(J._first_keys(text))
    whole, parts = J._Cutter(0, 0, marker), J._Cutter(0, 0, marker)
    whole.add(text)
    edges = [0, *J._certain(text, marker).tolist(), len(text)]
    assert len(edges) == 201
    for begin, end in zip(edges, edges[1:]):
        if begin:
            parts._close()
            parts.inside, parts.depth = 0, 1
        parts.marker = None
        parts.add(text[begin:end])
    assert whole.out == parts.out and len(whole.out) == 200
    assert (whole.inside, whole.depth) == (parts.inside, parts.depth) == (0, 0)


@pytest.mark.parametrize("count", [2000, 3500])
def test_text_scanned_in_pieces(spark, tmp_path, count):
    """A block of more bytes than are scanned at once, in one block of one file."""
    records = [{"id": i, "title": "x" * 900} for i in range(count)]
    put(tmp_path, "one.json", json.dumps(records).replace('"id": 7,', '"id": "7,'))
    assert read(spark, tmp_path) == ({"one": (count - 1, count - 1, 1)}, set())
