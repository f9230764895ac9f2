"""Streams over a landing folder."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vacancia import fixed_values as V
from vacancia import schemas as S
from vacancia.context import RunContext
from vacancia.plans.bronze import load_bronze
from vacancia.plans.silver import load_pending, load_silver
from vacancia.sources import tables as B
from vacancia.streaming import ingest as K

CTX = RunContext.create("2026-09-21", "b1")


def posting(i, **more):
    return {"id": i, "title": f"Job {i}", "company": "C", "description": "D", "url": f"https://h/{i}", "city": "Abha",
            "collected_at": f"2026-09-21 00:00:{i % 60:02d}", **more}


def put(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump(records, f, indent=2)


def test_files_are_read_once_and_archived(spark, tmp_path):
    landing, archive, path, state = (str(tmp_path / n) for n in ("landing", "archive", "bronze", "state"))
    prefix = V.FILE_PREFIXES[2]

    def run():
        rows = K.bronze_stream(spark, landing, prefix, archive)
        K.bronze_writer(rows, path, state, CTX, prefix).awaitTermination()
        return B.read_table(spark, path, S.BRONZE).count()

    put(landing, "Tanqeeb_1.json", [posting(1), posting(2)])
    put(landing, "tanqeeb_2.json", [])
    put(landing, "other.json", [posting(9)])
    assert run() == 2
    assert run() == 2
    put(landing, "tanqeeb_3.json", [posting(3)])
    assert run() == 3
    put(landing, "tanqeeb_4.json", [posting(4)])
    assert run() == 4
    archived = [f for _, _, files in os.walk(archive) for f in files]
    assert "Tanqeeb_1.json" in archived and "other.json" in os.listdir(landing)


def test_unreadable_pieces_stop_the_stream_or_are_put_aside(spark, tmp_path):
    landing, bronze, kept, state, other = (str(tmp_path / n) for n in ("landing", "bronze", "kept", "state", "other"))
    prefix = V.FILE_PREFIXES[2]
    put(landing, "tanqeeb_1.json", [posting(1), posting(2)])
    with open(landing + "/tanqeeb_2.json", "w") as f:
        f.write(json.dumps([posting(3), posting(4), posting(5)], indent=2).replace('"id": 4', '"id": four'))
    with open(landing + "/tanqeeb_3.json", "w") as f:
        f.write(json.dumps([posting(6), posting(7)], indent=2)[:-6])
    with pytest.raises(StreamingQueryException, match="cannot be read"):
        K.bronze_writer(K.bronze_stream(spark, landing, prefix), bronze, other, CTX, "x").awaitTermination()

    def run():
        K.load_landing(spark, landing, prefix, bronze, kept, state, CTX).awaitTermination()
        lost = [(r["_source_file"][-6], r["reason"]) for r in spark.read.parquet(kept).collect()]
        return sorted(r["raw_job_id"] for r in B.read_table(spark, bronze, S.BRONZE).collect()), sorted(lost)

    first = (["1", "2", "3", "5", "6", "7"], [("2", "broken"), ("3", "cut off")])
    assert run() == first
    assert run() == first
    put(landing, "tanqeeb_4.json", [posting(8)])
    assert run() == ([*first[0], "8"], first[1])


def test_stream_equals_batch(spark, tmp_path):
    landing = str(tmp_path / "landing")
    put(landing, "tanqeeb_1.json", [posting(i) for i in range(40)] + [posting(50, title="N/A"), posting(51, country="Egypt")])
    put(landing, "tanqeeb_2.json", [posting(i, title=f"job {i}") for i in range(30, 60)])
    d = {n: str(tmp_path / n) for n in ("bronze", "s1", "r1", "s2", "r2", "state")}
    load_bronze(spark, landing, d["bronze"], CTX)
    for _ in range(2):
        load_silver(spark, d["bronze"], d["s1"], d["r1"], CTX, buckets=4)
    rows = K.bronze_stream(spark, landing, V.FILE_PREFIXES[2])
    K.upsert_stream(rows, d["s2"], d["r2"], d["state"], CTX, buckets=4).awaitTermination()
    batch, stream = (B.read_keyed(spark, d[n], S.SILVER) for n in ("s1", "s2"))
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect())) != []
    for n in ("r1", "r2"):
        rejects = B.read_table(spark, d[n], S.REJECTED)
        assert sorted(r["reject_reasons"][0] for r in rejects.collect()) == ["country", "title"]


def test_stream_dedup_drops_repeats_and_late_rows(spark, tmp_path):
    source, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "job_id string, collected_ts timestamp"

    def run(rows):
        df = spark.createDataFrame(rows, "job_id string, t string")
        df.select("job_id", F.to_timestamp("t").alias("collected_ts")).coalesce(1).write.mode("append").parquet(source)
        stream = K.dedup_stream(spark.readStream.schema(schema).parquet(source), "1 hour")
        writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", state)
        writer.trigger(availableNow=True).start().awaitTermination()
        return sorted(r["job_id"] for r in spark.read.schema(schema).parquet(path).collect())

    assert run([("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 00:01:00"), ("b", "2026-01-01 00:02:00")]) == ["a", "b"]
    assert run([("a", "2026-01-01 00:10:00"), ("c", "2026-01-02 00:00:00")]) == ["a", "b", "c"]
    assert run([("late", "2026-01-01 00:00:00"), ("d", "2026-01-02 00:30:00")]) == ["a", "b", "c", "d"]


def test_landed_batches_reach_silver_once(spark, tmp_path, monkeypatch):
    """Files in two layouts land, the run breaks off and is replayed on the next day, then both days load."""
    d = {n: str(tmp_path / n) for n in ("landing", "bronze", "kept", "state", "silver", "rejected")}
    prefix, days = V.FILE_PREFIXES[2], [RunContext.create(day, "run") for day in ("2026-09-21", "2026-09-22")]

    def land(ctx):
        K.load_landing(spark, d["landing"], prefix, d["bronze"], d["kept"], d["state"], ctx).awaitTermination()
        table = B.read_table(spark, d["bronze"], S.BRONZE)
        return sorted((r["raw_job_id"], str(r["_load_date"])) for r in table.select("raw_job_id", "_load_date").collect())

    put(d["landing"], "tanqeeb_1.json", [posting(1), posting(2), posting(3, title="")])
    with open(d["landing"] + "/tanqeeb_[2].json", "w") as f:
        json.dump([posting(4)], f)
    whole, calls = K.write_batch, []

    def breaks_off(rows, path, ctx):
        whole(rows, path, ctx)
        if path == d["bronze"]:
            calls.append(ctx)
            raise RuntimeError("stopped after the write")

    monkeypatch.setattr(K, "write_batch", breaks_off)
    with pytest.raises(StreamingQueryException):
        land(days[0])
    monkeypatch.setattr(K, "write_batch", whole)
    assert len(calls) == 1
    first = [(str(i), "2026-09-21") for i in (1, 2, 3, 4)]
    assert land(days[1]) == first  # the replay keeps the day of the first attempt
    put(d["landing"], "tanqeeb_5.json", [posting(5)])
    assert land(days[1]) == [*first, ("5", "2026-09-22")]

    def load():
        done = load_pending(spark, d["bronze"], d["silver"], d["rejected"], days[1], buckets=4)
        silver = B.read_keyed(spark, d["silver"], S.SILVER)
        rejects = B.read_table(spark, d["rejected"], S.REJECTED)
        return done, sorted(r["job_url"] for r in silver.collect()), [r["reject_reasons"] for r in rejects.collect()]

    urls = [f"https://h/{i}" for i in (1, 2, 4, 5)]
    assert load() == ([f"{prefix}.0", f"{prefix}.1"], urls, [["title"]])
    assert load() == ([], urls, [["title"]])
    put(d["landing"], "tanqeeb_6.json", [posting(6)])
    land(days[1])
    assert load() == ([f"{prefix}.2"], [*urls, "https://h/6"], [["title"]])


def test_a_landed_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    """Bronze and quarantine are written from the same parsed pieces."""
    landing, bronze, kept, state = (str(tmp_path / n) for n in ("landing", "bronze", "kept", "state"))
    put(landing, "tanqeeb_1.json", [posting(i) for i in range(5)])
    from vacancia.plans import bronze as P

    calls, parse = [], K.parse_pieces

    def counted(*args):
        calls.append(1)
        return parse(*args)

    monkeypatch.setattr(K, "parse_pieces", counted)
    monkeypatch.setattr(P, "parse_pieces", counted)
    K.load_landing(spark, landing, V.FILE_PREFIXES[2], bronze, kept, state, CTX).awaitTermination()
    assert B.read_table(spark, bronze, S.BRONZE).count() == 5 and len(calls) == 1


def test_files_are_listed_by_few_tasks(spark):
    """Listing named files costs a few tasks a core, whatever their number."""
    tasks = int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism"))
    assert tasks == 4 * spark.sparkContext.defaultParallelism
