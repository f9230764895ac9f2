"""Star schema: repeated loads, broken loads, stable keys, integrity, skew."""

import pytest
from pyspark.sql import functions as F

from checks.postings import raw_postings
from vacancia import schemas as S
from vacancia.context import materialize
from vacancia.operators import dims as D
from vacancia.operators import quality as H
from vacancia.operators.keys import assign_keys, assign_keys_apart, assign_keys_by
from vacancia.operators.merge import merge_upsert
from vacancia.plans import gold as G
from vacancia.plans.silver import silver_batch
from vacancia.sources import tables as B

NOW = "2031-01-01 00:00:00"


@pytest.fixture(scope="module")
def silver(spark, sf):
    return materialize(silver_batch(raw_postings(spark, sf).drop("k"), NOW)[0])


def counts(gold):
    return {**{n: d.count() for n, d in gold.dims.items()}, "fact": gold.fact.count(), "links": gold.links.count()}


def test_reload_is_a_no_op_and_keys_stay(spark, silver, tmp_path):
    folder = str(tmp_path)
    first = G.load_gold(silver.filter("collected_at < '2028-01-01'"), folder)
    keys = {n: set(map(tuple, d.collect())) for n, d in first.dims.items()}
    facts = set(map(tuple, first.fact.drop(G.LOAD_ID).collect()))
    second = G.load_gold(silver, folder)
    assert all(keys[n] <= set(map(tuple, d.collect())) for n, d in second.dims.items())
    assert facts <= set(map(tuple, second.fact.drop(G.LOAD_ID).collect()))
    assert counts(G.load_gold(silver, folder)) == counts(second)
    assert second.fact.count() == silver.count()

    d, f = second.dims, second.fact
    checks = [
        H.check_fk(f, d["source"], "source_key"), H.check_fk(f, d["company"], "company_key"),
        H.check_fk(f, d["location"], "location_key"), H.check_fk(f, d["job"], "job_key"),
        H.check_fk(f, d["date"], "posted_date_key", "date_key"), H.check_fk(second.links, d["skill"], "skill_key"),
        H.check_fk(second.links, f, "job_posting_key"), H.check_pk(f, ["job_posting_key"], "fact"),
        H.check_pk(second.links, ["job_posting_key", "skill_key"], "links"),
        *[H.check_pk(d[n], [f"{n}_key"], n) for n in d],
    ]
    for check in checks:
        H.enforce(check)
    for key in ("source_key", "company_key", "location_key", "job_key"):
        assert f.filter(F.col(key).isNull()).count() == 0


def test_broken_load_is_completed(spark, silver, tmp_path, monkeypatch):
    folder, whole = str(tmp_path / "broken"), G.load_gold(silver, str(tmp_path / "whole"))

    def fail(*args, **kwargs):
        raise RuntimeError("broken off")

    with monkeypatch.context() as patch:
        patch.setattr(D, "bridge", fail)
        with pytest.raises(RuntimeError):
            G.load_gold(silver, folder)
    half = G.read_gold(spark, folder)
    assert half.fact.count() == silver.count() and half.links.count() == 0 and half.watermark.count() == 0
    done = G.load_gold(silver, folder)
    assert counts(done) == counts(whole)
    assert counts(G.load_gold(silver, folder)) == counts(whole)


def test_updated_posting_adds_nothing(spark, silver, tmp_path):
    """Facts are insert-only: a newer version of a known posting passes the watermark but not the anti join."""
    folder = str(tmp_path)
    before = counts(G.load_gold(silver, folder))
    newer = silver.limit(5).withColumn("collected_at", F.lit("2035-01-01 00:00:00")).withColumn("skills", F.lit("brand new"))
    after = counts(G.load_gold(merge_upsert(silver, newer, ["job_id"]), folder))
    assert after == before
    assert G.read_gold(spark, folder).watermark.agg(F.max("last_loaded_at")).first()[0].year == 2035


def test_nothing_to_load(spark, tmp_path):
    gold = G.load_gold(spark.createDataFrame([], S.SILVER), str(tmp_path))
    assert set(counts(gold).values()) == {0}


def test_keys_are_dense_in_natural_order_with_nulls_first(spark):
    rows = [(None, "b"), ("x", None), (None, None), ("a", "z"), ("a", "b")]
    df = spark.createDataFrame(rows, "p string, q string").repartition(5)
    got = [(r["k"], r["p"], r["q"]) for r in assign_keys(df, ["p", "q"], "k", 10).orderBy("k").collect()]
    assert got == [(11, None, None), (12, None, "b"), (13, "a", "b"), (14, "a", "z"), (15, "x", None)]
    assert assign_keys(df.limit(0), ["p", "q"], "k").count() == 0


def test_keys_over_many_tasks(spark):
    df = spark.range(0, 50000, 1, 16).select(((F.col("id") * 7919) % 50000).alias("id"))
    keyed = assign_keys(df, ["id"], "k")
    assert keyed.filter(F.col("k") != F.col("id") + 1).count() == 0 and keyed.count() == 50000


def test_keys_of_groups_by_one_sort(spark):
    df = spark.range(0, 30000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), ((F.col("id") * 7919) % 30000).alias("v")
    )
    keyed = assign_keys_by(df, "g", ["v"], "k", {"a": 5, "none": 9, "b": 100})
    for group, start in (("a", 5), ("b", 100)):
        rows = [(r.k, r.v) for r in keyed.filter(F.col("g") == group).orderBy("v").collect()]
        assert [k for k, _ in rows] == list(range(start + 1, start + 1 + len(rows))) and len(rows) >= 10000
    assert assign_keys_by(df.limit(0), "g", ["v"], "k", {"a": 0}).count() == 0


def test_keys_apart_from_wide_rows(spark):
    """Nulls and repeated keys get one number each; the rows themselves are neither sorted nor stored again."""
    rows = [(3, None, "x"), (1, "b", "y"), (2, "b", "z"), (0, "a", None)]
    df = materialize(spark.createDataFrame(rows, "r long, p string, body string"))
    keyed = assign_keys_apart(df, "r", ["p"], "k", 10)
    assert sorted(keyed.collect()) == [(11, None, "x"), (12, "a", None), (13, "b", "y"), (14, "b", "z")]
    assert keyed.columns == ["k", "p", "body"]
    assert assign_keys_apart(df.limit(0), "r", ["p"], "k").count() == 0


def test_members_of_all_dimensions_in_one_pass(spark, silver):
    odd = silver.limit(3).withColumns({c: F.lit(None).cast("string") for c in ("company_name", "city", "posted_date", "source")})
    rows = D.prepare(silver.unionByName(odd), "collected_at")
    found = materialize(D.all_members(rows, "collected_at"))
    expected = {
        "source": D.dim_members(rows.select(F.col("source").alias("source_name")), ["source_name"]),
        "company": D.company_members(rows),
        "location": D.dim_members(rows, ["country", "city"], keep_null=True),
        "job": D.dim_members(rows, S.JOB_ATTRIBUTES, keep_null=True),
        "date": rows.select(F.col("posted_date").try_cast("date").alias("day")).dropna().distinct(),
    }
    for name, want in expected.items():
        got = found.filter(F.col("dimension") == name).select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert found.agg(F.max("stamp")).first()[0] == silver.agg(F.max("collected_at")).first()[0]
    plan = D.all_members(rows, "collected_at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1
    assert D.all_members(rows.limit(0), "collected_at").count() == 0


def test_large_dimension_is_not_broadcast(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), F.lit(100)).alias("t"))
    small, large = (D.broadcast_small({"d": df}, limit)["d"] for limit in (1 << 20, 1 << 10))
    assert "broadcast" in small._jdf.queryExecution().logical().toString()
    assert "broadcast" not in large._jdf.queryExecution().logical().toString()


def test_half_batches_equal_one(spark, tmp_path, silver):
    """Two upserts with overlap give the same table as one upsert of all rows."""
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    B.upsert_table(spark, one, silver, ["job_id"], 4)
    B.upsert_table(spark, two, silver.filter("collected_at < '2029-01-01'"), ["job_id"], 4)
    B.upsert_table(spark, two, silver.filter("collected_at > '2028-01-01'"), ["job_id"], 4)
    a, b = (set(map(tuple, B.read_keyed(spark, p, S.SILVER).collect())) for p in (one, two))
    assert a == b


def test_resolved_keys_derive_silver_once(spark, sf, monkeypatch):
    from checks import all_queries, gold_serving

    calls, silver = [], gold_serving.silver
    monkeypatch.setattr(gold_serving, "silver", lambda *args: calls.append(1) or silver(*args))
    all_queries()["i8_resolve_keys"](spark, sf)
    assert len(calls) == 1
