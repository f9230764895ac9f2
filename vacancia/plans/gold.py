"""Silver -> Gold star schema, incrementally."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia import fixed_values as V
from vacancia import schemas as S
from vacancia.context import materialize
from vacancia.operators import dims as D
from vacancia.operators.keys import next_start
from vacancia.operators.merge import missing_from, rows_with_keys_of
from vacancia.sources.tables import read_table

SCHEMAS = {
    "source": S.DIM_SOURCE,
    "company": S.DIM_COMPANY,
    "location": S.DIM_LOCATION,
    "job": S.DIM_JOB,
    "date": S.DIM_DATE,
    "skill": S.DIM_SKILL,
}
# Each load marks its facts; the watermark lists the loads that reached their end.
LOAD_ID = "_load_id"
FACT_STORED = T.StructType([*S.FACT.fields, T.StructField(LOAD_ID, T.StringType())])
WATERMARK_STORED = T.StructType([*S.WATERMARK.fields, T.StructField(LOAD_ID, T.StringType())])
# Numbers the candidates of one load.
ROW = "_row"


@dataclass(frozen=True)
class Gold:
    """The star schema at one point in time."""

    dims: dict[str, DataFrame]
    fact: DataFrame
    links: DataFrame
    watermark: DataFrame


@dataclass(frozen=True)
class Increment:
    """What one load adds: facts, skills not known before, skills per posting, the watermark."""

    fact: DataFrame
    dims: dict[str, DataFrame]
    skills: DataFrame
    watermark: DataFrame


def empty_gold(spark: SparkSession) -> Gold:
    return Gold(
        {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()},
        spark.createDataFrame([], FACT_STORED),
        spark.createDataFrame([], S.BRIDGE),
        spark.createDataFrame([], WATERMARK_STORED),
    )


def dim_increments(members: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """New members of every dimension but skills."""
    days = D.dim_date(members.filter(F.col("dimension") == "date"), "day")
    return {**D.new_keyed(members, dims), "date": missing_from(days, dims["date"], ["date_key"])}


def changed_rows(
    silver: DataFrame, gold: Gold, pipeline: str, lookback: timedelta = timedelta(0)
) -> tuple[DataFrame, DataFrame, str | None]:
    """Silver rows stamped after the watermark less the lookback, prepared; their members; their highest stamp."""
    changes = D.since(silver, "collected_at", D.read_watermark(gold.watermark, pipeline), lookback)
    members = materialize(D.all_members(D.prepare(changes, "collected_at"), "collected_at"))
    return D.prepare(changes), members, members.agg(F.max("stamp")).first()[0]


def fact_increment(prepared: DataFrame, gold: Gold, stamp: str, pipeline: str) -> Increment:
    """New facts and their skills, once the other dimensions hold every value.

    A load that broke off after its facts but before its links is completed: its postings are
    linked now.
    """
    load_id = uuid.uuid4().hex
    candidates = D.resolve_keys(prepared, gold.dims)
    candidates = materialize(candidates.withColumn(ROW, F.monotonically_increasing_id()))
    stored = gold.fact.select("job_posting_key", *D.FACT_KEY, LOAD_ID)
    known = materialize(rows_with_keys_of(stored, candidates, D.FACT_KEY))
    new = candidates.join(known, D.FACT_KEY, "left_anti").select(*candidates.columns)
    keyed = D.to_fact(new, ROW, next_start(gold.fact, "job_posting_key"))

    finished = gold.watermark.select(LOAD_ID).distinct()
    unlinked = known.join(finished, LOAD_ID, "left_anti").join(candidates, D.FACT_KEY)
    skills = D.explode_skills(
        keyed.select("job_posting_key", "skills").unionByName(unlinked.select("job_posting_key", "skills"))
    )
    names = D.dim_members(skills, ["skill_name"])
    added = D.new_members(gold.dims["skill"], names, ["skill_name"], "skill_key")
    watermark = prepared.sparkSession.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(stamp).try_cast("timestamp").alias("last_loaded_at"),
        F.lit(load_id).alias(LOAD_ID),
    )
    fact = keyed.drop("skills").withColumn(LOAD_ID, F.lit(load_id))
    return Increment(fact, {"skill": added}, skills, watermark)


def with_dims(gold: Gold, added: dict[str, DataFrame]) -> Gold:
    return replace(gold, dims={n: d.unionByName(added[n]) if n in added else d for n, d in gold.dims.items()})


def load_increment(silver: DataFrame, gold: Gold, pipeline: str = V.PIPELINE_NAME) -> Gold:
    """The star schema with the new rows of Silver added, nothing stored."""
    prepared, members, stamp = changed_rows(silver, gold, pipeline)
    if stamp is None:
        return gold
    gold = with_dims(gold, dim_increments(members, gold.dims))
    inc = fact_increment(prepared, gold, stamp, pipeline)
    gold = with_dims(gold, inc.dims)
    return replace(
        gold,
        fact=gold.fact.unionByName(inc.fact),
        links=gold.links.unionByName(D.bridge(inc.skills, gold.dims["skill"], gold.links)),
        watermark=gold.watermark.unionByName(inc.watermark),
    )


def read_gold(spark: SparkSession, folder: str) -> Gold:
    return Gold(
        {n: read_table(spark, f"{folder}/dim_{n}", s) for n, s in SCHEMAS.items()},
        read_table(spark, f"{folder}/fact_job_posting", FACT_STORED),
        read_table(spark, f"{folder}/bridge_job_posting_skill", S.BRIDGE),
        read_table(spark, f"{folder}/etl_watermark", WATERMARK_STORED),
    )


def load_gold(
    silver: DataFrame, folder: str, pipeline: str = V.PIPELINE_NAME, lookback: timedelta = timedelta(0)
) -> Gold:
    """Add what is new in Silver to the stored star schema; repeating it changes nothing.

    Rows that reach Silver with a stamp before the watermark are found again within `lookback`.

    Dimensions go first, then facts, skills, links and, last, the watermark. A load that breaks off leaves
    the watermark where it was: the next one sees the same rows again and adds what is missing.
    """
    spark = silver.sparkSession
    gold = read_gold(spark, folder)
    prepared, members, stamp = changed_rows(silver, gold, pipeline, lookback)
    if stamp is None:
        return gold
    for name, rows in dim_increments(members, gold.dims).items():
        rows.write.mode("append").parquet(f"{folder}/dim_{name}")
    gold = read_gold(spark, folder)
    inc = fact_increment(prepared, gold, stamp, pipeline)
    inc.fact.write.mode("append").partitionBy(LOAD_ID).parquet(f"{folder}/fact_job_posting")
    inc.dims["skill"].write.mode("append").parquet(f"{folder}/dim_skill")
    links = D.bridge(inc.skills, read_gold(spark, folder).dims["skill"], gold.links)
    links.write.mode("append").parquet(f"{folder}/bridge_job_posting_skill")
    inc.watermark.write.mode("append").parquet(f"{folder}/etl_watermark")
    return read_gold(spark, folder)
