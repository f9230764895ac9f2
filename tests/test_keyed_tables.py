"""Keyed tables: growth of the buckets, what a load reads and writes, and stops at any step."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from vacancia.sources import tables as B

SCHEMA = "job_id string, salary string"


def rows(spark, keys, salary):
    return spark.createDataFrame([(f"{k}", salary) for k in keys], SCHEMA)


def held(spark, path):
    table = B.read_keyed(spark, path, rows(spark, [], "").schema)
    return sorted((int(r["job_id"]), r["salary"]) for r in table.collect())


def files(path):
    return {f: f.split("/")[-2] for f in glob.glob(f"{path}/*/*.parquet")}


def test_buckets_are_split_in_turn(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    for before in range(1, 40):
        moved = keys.select(B.bucket_of(["k"], before).alias("a"), B.bucket_of(["k"], before + 1).alias("b")).groupBy("a", "b").count().collect()
        assert {r["a"] for r in moved} == set(range(before)) and {r["b"] for r in moved} == set(range(before + 1))
        source, new = B._split_sources(before, before + 1)
        assert new == before
        assert all(r["a"] == r["b"] or (r["a"], r["b"]) == (source, before) for r in moved)


def test_growth_follows_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert B.upsert_table(spark, path, rows(spark, range(50), "a"), ["job_id"], 2, 20) == {"inserted": 50, "updated": 0}
    assert B.table_state(spark, path).buckets == 3 and len(held(spark, path)) == 50
    assert B.upsert_table(spark, path, rows(spark, range(40, 230), "b"), ["job_id"], 2, 20) == {"inserted": 180, "updated": 10}
    state = B.table_state(spark, path)
    assert (state.buckets, state.rows, state.staged) == (12, 230, None)
    assert held(spark, path) == [(k, "a" if k < 40 else "b") for k in range(230)]
    folder = B._folder(path, state.version)
    stored = spark.read.parquet(folder)
    assert stored.filter(F.col(B.BUCKET) != B.bucket_of(["job_id"], 12)).count() == 0
    before = files(folder)
    B.upsert_table(spark, path, rows(spark, [7], "c"), ["job_id"], 2, 20)
    gone = {b for f, b in before.items() if f not in files(folder)}
    assert len(gone) == 1  # of twelve


def stop_at(monkeypatch, name, call):
    """Let the call-th use of a function do its work and then stop the load."""
    whole, seen = getattr(B, name), []

    def stopping(*args, **kwargs):
        out = whole(*args, **kwargs)
        seen.append(name)
        if len(seen) == call:
            raise RuntimeError("stopped")
        return out

    monkeypatch.setattr(B, name, stopping)


@pytest.mark.parametrize("name, call", [(n, i) for n in ("_write_buckets", "_record") for i in range(1, 5)] + [("_delete", 1)])
def test_a_load_that_stops_may_be_repeated(spark, tmp_path, monkeypatch, name, call):
    path = str(tmp_path / "t")
    B.upsert_table(spark, path, rows(spark, range(30), "a"), ["job_id"], 2, 10)
    with monkeypatch.context() as patch:
        stop_at(patch, name, call)
        with pytest.raises(RuntimeError):
            B.upsert_table(spark, path, rows(spark, range(20, 70), "b"), ["job_id"], 2, 10)
    # Every row there is whole and there once, whatever the load got done.
    assert [k for k, _ in held(spark, path)] in (list(range(30)), list(range(70)))
    B.upsert_table(spark, path, rows(spark, range(20, 70), "b"), ["job_id"], 2, 10)
    assert held(spark, path) == [(k, "a" if k < 20 else "b") for k in range(70)]
    state = B.table_state(spark, path)
    assert state.staged is None and state.buckets >= 3
    B.upsert_table(spark, path, rows(spark, range(60, 75), "c"), ["job_id"], 2, 10)
    assert held(spark, path) == [(k, "a" if k < 20 else "b" if k < 60 else "c") for k in range(75)]


@pytest.mark.parametrize("name", ["_write_buckets", "_record"])
@pytest.mark.parametrize("done", [True, False])
def test_a_replaced_table_is_the_old_or_the_new_one(spark, tmp_path, monkeypatch, name, done):
    path = str(tmp_path / "t")
    B.upsert_table(spark, path, rows(spark, range(30), "a"), ["job_id"], 4)
    old, new = held(spark, path), [(k, "z") for k in range(0, 30, 2)]
    derived = B.read_keyed(spark, path, rows(spark, [], "").schema).filter("CAST(job_id AS INT) % 2 = 0").withColumn("salary", F.lit("z"))
    with monkeypatch.context() as patch:
        if done:
            stop_at(patch, name, 1)
        else:
            patch.setattr(B, name, lambda *args, **kwargs: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            B.replace_table(spark, path, derived, ["job_id"])
    assert held(spark, path) == (new if (name, done) == ("_record", True) else old)
    if held(spark, path) == old:
        B.replace_table(spark, path, derived, ["job_id"])
    assert held(spark, path) == new
    assert B.upsert_table(spark, path, rows(spark, [0, 1], "y"), ["job_id"]) == {"inserted": 1, "updated": 1}
    assert B.expire_versions(spark, path) == [path] and len(held(spark, path)) == 16


def test_a_record_that_was_cut_off_leaves_the_one_before(spark, tmp_path):
    path = str(tmp_path / "t")
    for turn in range(3):
        B.upsert_table(spark, path, rows(spark, [turn], "a"), ["job_id"], 2)
        seq = B.table_state(spark, path).seq
        assert seq == turn + 1
    for file in glob.glob(f"{path}__state/{seq % 2}/part-*"):
        os.remove(file)
    assert B.table_state(spark, path).seq == seq - 1
