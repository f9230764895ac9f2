"""Landing files, tables and exports on hand-made files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from vacancia import schemas as S
from vacancia.context import RunContext
from vacancia.operators.quality import QualityError
from vacancia.plans import silver as P
from vacancia.plans.bronze import landed_postings, load_bronze, unreadable
from vacancia.sources import json_export as J
from vacancia.sources import landing as L
from vacancia.sources import tables as B

CTX = RunContext.create("2026-09-21", "b1")


def nested(ident, **job):
    return {
        "job_id": ident, "job_url": f"https://h/jobs/p/{ident}", "job_attributes": {"title": "T", "description": "D", **job},
        "company_attributes": {"name": "C"}, "collected_at": "2026-09-21 01:02:03", "batch_id": "x",
    }


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def put(name, records, **kwargs):
        (folder / name).write_text(json.dumps(records, ensure_ascii=False, **kwargs), encoding="utf8")

    put("Wuzzuf_2026-09-21.json", [nested("a", salary={"min": 10, "max": 20.50, "currency": {"code": "USD"}}),
                                   nested("b", workTypes=[], keywords=[None, {"name": "sql"}, {}, {"name": "x},\n  {"}])], indent=2)
    put("tanqeeb_1.json", [{"id": 7, "title": "ت", "url": "u1", "location": "Olaya, Riyadh", "collected_at": "2026-09-20"}])
    put("tanqeeb_2.json", [{"job_id": "8", "job_title": "", "url": "u2", "city": "Abha"}, {}], indent=2)
    put("sabbar_1.json", [])
    put("other.json", [{"id": 1, "title": "not ours"}], indent=2)
    (folder / "wuzzuf.txt").write_text("not json at all")
    return str(folder)


def test_inventory_and_latest(spark, landing):
    files = {r["name"]: r["source"] for r in L.landing_files(spark, landing).collect()}
    assert files == {
        "Wuzzuf_2026-09-21.json": "wuzzuf", "tanqeeb_1.json": "tanqeeb", "tanqeeb_2.json": "tanqeeb", "sabbar_1.json": "sabbar"
    }
    latest = {r["name"] for r in L.latest_per_source(L.landing_files(spark, landing)).collect()}
    assert latest == {"Wuzzuf_2026-09-21.json", "tanqeeb_2.json", "sabbar_1.json"}


def test_landed_postings(spark, landing):
    rows = {r["raw_job_id"]: r for r in landed_postings(spark, landing).collect()}
    assert set(rows) == {"a", "b", "7", "8", ""}
    assert rows["a"]["raw_salary"] == "10 - 20.5 USD" and rows["a"]["raw_collected_at"] == "2026-09-21 01:02:03"
    assert rows["b"]["raw_skills"] == "sql; x},\n  {" and rows["b"]["raw_employment_type"] is None
    assert rows["7"]["raw_city"] == "Riyadh" and rows["7"]["raw_country"] == "Saudi Arabia"
    only = {r["raw_job_id"] for r in landed_postings(spark, landing, latest_only=True).collect()}
    assert only == {"a", "b", "8", ""}


def test_latest_file_is_the_last_with_records_however_short(spark, tmp_path):
    for name, text in {"sabbar_1.json": '[{"id":3}]', "sabbar_2.json": '[{"a":1}]', "sabbar_3.json": "[]", "sabbar_4.json": " " * 50}.items():
        (tmp_path / name).write_text(text)
    rows = landed_postings(spark, str(tmp_path), latest_only=True).collect()
    assert [r["raw_job_id"] for r in rows] == [""]
    assert landed_postings(spark, str(tmp_path)).count() == 2


def test_nothing_landed(spark, tmp_path):
    assert landed_postings(spark, str(tmp_path)).count() == 0
    assert landed_postings(spark, str(tmp_path), latest_only=True).count() == 0


def test_corrupt_file_is_kept_apart(spark, landing):
    with open(landing + "/sabbar_2.json", "w") as f:
        f.write('[\n  {\n    "id": 1\n  },\n  {\n    "id": broken\n  },\n  {\n    "id": 3\n  }\n]')
    rows = L.read_postings(spark, landing + "/sabbar_2.json", S.RAW_FLAT_A).collect()
    assert sorted(str(r["id"]) for r in rows) == ["1", "3", "None"]
    assert [("broken" in r["_corrupt_record"]) for r in rows if r["id"] is None] == [True]
    assert unreadable(spark, landing).filter("reason = 'broken'").count() == 1


def test_file_record_counts(spark, landing):
    counts = L.file_record_counts(spark, landing + "/*.json", "tanqeeb").collect()
    assert [r["records"] for r in counts if r["_source_file"].endswith("_1.json")] == [1]
    assert [r["records"] for r in counts if r["_source_file"].endswith("_2.json")] == [2]
    empty = L.file_record_counts(spark, landing + "/*.json", "SABBAR").collect()
    assert [r["records"] for r in empty] == [0]


def test_large_array_file_is_split(spark, tmp_path):
    path = tmp_path / "wuzzuf_big.json"
    path.write_text(json.dumps([nested(str(i), description="x" * 500) for i in range(3000)], indent=2))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        rows = L.read_postings(spark, str(path), S.RAW_NESTED)
        assert rows.rdd.getNumPartitions() > 5
        assert rows.select("job_id").distinct().count() == 3000 == rows.filter("_corrupt_record IS NULL").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_checkpoint_round(spark, tmp_path):
    path = tmp_path / "checkpoint.json"
    urls = ["https://h/ا?x=1", 'https://h/"q"', "https://h/a\\b", "https://h/a\\b"]
    for kwargs in ({"indent": 2}, {}):
        path.write_text(json.dumps(urls, ensure_ascii=False, **kwargs), encoding="utf8")
        assert sorted(r["url"] for r in L.read_checkpoint(spark, str(path)).collect()) == sorted(set(urls))
    stored = spark.createDataFrame([("b",), ("",), (None,), ("a",), ("b",)], "url string")
    assert [r["url"] for r in L.rebuild_checkpoint(stored, stored).collect()] == ["a", "b"]


def test_checkpoint_is_a_sorted_list(spark, tmp_path):
    path, urls = str(tmp_path / "known"), ["https://h/ا", 'https://h/"q"', "https://h/a\\b", "a", "a", "", None]
    J.write_checkpoint(spark.createDataFrame([(u,) for u in urls], "url string").repartition(3), path)
    parts = sorted(str(p) for p in (tmp_path / "known").glob("part-*"))
    kept = sorted({u for u in urls if u})
    assert json.loads("".join(open(p, encoding="utf8").read() for p in parts)) == kept
    assert sorted(r["url"] for r in L.read_checkpoint(spark, path).collect()) == kept
    J.write_checkpoint(spark.createDataFrame([], "url string"), path)
    assert L.read_checkpoint(spark, path).count() == 0


def test_batch_rerun_replaces_only_itself(spark, tmp_path, landing):
    path = str(tmp_path / "bronze")
    other = RunContext.create("2026-09-21", "b2")
    for ctx in (CTX, other, CTX):
        load_bronze(spark, landing, path, ctx)
    table = B.read_table(spark, path, S.BRONZE)
    assert table.count() == 10 and B.read_batch(table, CTX).count() == 5
    B.write_batch(B.read_batch(table, other).limit(0), path, CTX)
    assert B.read_table(spark, path, S.BRONZE).count() == 5
    plan = B.read_batch(table, CTX)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load_date" in plan


def test_context():
    with pytest.raises(ValueError):
        RunContext.create("2026-09-21", "a/b")
    with pytest.raises(ValueError):
        RunContext.create("21.9.2026", "b")
    ctx = RunContext.create(" ", "")
    assert ctx.load_date == ctx.now[:10] and ctx.batch_id[:8] == ctx.load_date.replace("-", "")


def test_json_array_is_one_document(spark, tmp_path):
    import glob

    rows = spark.range(0, 1000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, F.lit("ش")).alias("v"))
    J.export_json_array(rows, str(tmp_path / "out"), [F.col("id").desc()])
    parts = sorted(glob.glob(str(tmp_path / "out" / "part-*")))
    data = json.loads("".join(open(p, encoding="utf8").read() for p in parts))
    assert [d["id"] for d in data] == list(range(999, -1, -1))
    assert data[0] == {"id": 999, "v": None}
    J.export_json_array(rows.limit(0), str(tmp_path / "none"), [F.col("id").asc()])
    text = "".join(open(p).read() for p in sorted(glob.glob(str(tmp_path / "none" / "part-*"))))
    assert json.loads(text) == []


def silver_rows(spark, rows):
    data = [{**{c: "x" for c in S.SILVER_COLUMNS}, "country": "Saudi Arabia", **r} for r in rows]
    return spark.createDataFrame(data, S.SILVER)


def test_upsert_touches_only_matching_buckets(spark, tmp_path):
    import glob

    path = str(tmp_path / "silver")
    first = silver_rows(spark, [{"job_id": f"{i}", "salary": "old"} for i in range(200)])
    B.upsert_table(spark, path, first, ["job_id"], buckets=16)
    before = {f for f in glob.glob(path + "/*/*.parquet")}
    B.upsert_table(spark, path, silver_rows(spark, [{"job_id": "7", "salary": "new"}, {"job_id": "n", "salary": "new"}]), ["job_id"], 16)
    after = {f for f in glob.glob(path + "/*/*.parquet")}
    assert len({f.split("/")[-2] for f in before - after}) == 1
    table = B.read_keyed(spark, path, S.SILVER)
    assert table.count() == 201 and table.filter("salary = 'new'").count() == 2
    # Another number of buckets changes nothing about the result.
    B.upsert_table(spark, path, silver_rows(spark, [{"job_id": f"{i}", "salary": "third"} for i in range(100)]), ["job_id"], 5)
    table = B.read_keyed(spark, path, S.SILVER)
    assert table.count() == 201 == table.select("job_id").distinct().count()
    assert table.filter("salary = 'third'").count() == 100


def test_gate_heals_then_passes(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [{"job_id": "1", "collected_at": "2026-01-01"}, {"job_id": "2", "collected_at": "2026-01-02"},
            {"job_id": "3", "city": "y"}]
    B.upsert_table(spark, path, silver_rows(spark, rows), ["job_id"], 4)
    assert {r["passed"] for r in P.gate_silver(spark, path, 4).collect()} == {True}
    assert {r["job_id"] for r in B.read_keyed(spark, path, S.SILVER).collect()} == {"2", "3"}


@pytest.mark.parametrize("bad", [{"country": "Egypt"}, {"job_title": " "}, {"collected_at": None}])
def test_gate_stops(spark, tmp_path, bad):
    path = str(tmp_path / "silver")
    B.upsert_table(spark, path, silver_rows(spark, [{"job_id": "1"}, {"job_id": "2", "city": "y", **bad}]), ["job_id"], 4)
    with pytest.raises(QualityError):
        P.gate_silver(spark, path, 4)


def test_unreadable_landing_is_not_lost(spark, tmp_path):
    landing, bronze, kept = (str(tmp_path / n) for n in ("in", "bronze", "quarantine"))
    os.mkdir(landing)
    whole = json.dumps([{"id": "1"}, {"id": "2"}], indent=2)
    files = {"sabbar_1.json": whole, "sabbar_2.json": whole[:-10], "sabbar_3.json": '[{"id":"1"},{"id":broken}]', "sabbar_4.json": '[{"id":"9"}]'}
    for name, text in files.items():
        with open(f"{landing}/{name}", "w") as f:
            f.write(text)
    with pytest.raises(ValueError):
        load_bronze(spark, landing, bronze, CTX)
    load_bronze(spark, landing, bronze, CTX, quarantine=kept)
    lost = {(r["_source_file"].split("/")[-1], r["reason"]) for r in spark.read.parquet(kept).collect()}
    assert {("sabbar_2.json", "cut off"), ("sabbar_3.json", "broken")} <= lost
    assert not {n for n, _ in lost} & {"sabbar_1.json", "sabbar_4.json"}


def test_mixed_lists_keep_their_objects(spark, tmp_path):
    """As in the reference, elements that are no objects are passed over."""
    mixed = {
        "a": (["x", {"name": "b"}, 7, None, ["y"], {}, {"name": ""}, {"name": "c \"d\""}], [{"name": "Full"}, "x"], 'b; c "d"', "Full"),
        "b": (["x", "y"], ["x", {"name": "Full"}], None, None),
        "c": ([{"name": "b"}], [{"name": "Full"}], "b", "Full"),
        "d": (None, None, None, None),
        "e": ({"name": "b"}, "Full", None, None),
        "f": (['{"name": "b"}', {"name": "c"}], [], "c", None),
    }
    records = [nested(k, keywords=words, workTypes=types) for k, (words, types, _, _) in mixed.items()]
    for indent in (None, 2):
        folder = tmp_path / f"landing{indent}"
        folder.mkdir()
        (folder / "wuzzuf_1.json").write_text(json.dumps(records, indent=indent), encoding="utf8")
        got = {r["raw_job_id"]: (r["raw_skills"], r["raw_employment_type"]) for r in landed_postings(spark, str(folder)).collect()}
        assert got == {k: (skills, kind) for k, (_, _, skills, kind) in mixed.items()}


def test_ends_of_pieces(spark):
    """Blank pieces, openings and closing brackets are told from the ends of a piece, however long its white space is."""
    space = " \t\r\n\x0b\f﻿"
    texts = ["", space, space + "]" + space, "]]", "] ]", " ", "x", space + '[{"id": 1}', '"id": 1', " " * 200_000 + "x", "\n]\n", '{"a": "\n]x"}']
    from vacancia.sources import landing as L

    value = F.col("value")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string").select(
        "i", L._is_blank(value).alias("a"), L._is_blank(value, closed=False).alias("b"), L._array_text(value).startswith("[{").alias("c")
    )
    got = {r["i"]: (r["a"], r["b"], r["c"]) for r in rows.collect()}
    assert [i for i in got if got[i][0]] == [0, 1, 2, 10] and [i for i in got if got[i][1]] == [0, 1]
    assert [i for i in got if not got[i][2]] == [7]
