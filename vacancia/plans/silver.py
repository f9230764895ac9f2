"""Bronze batch -> standardized, deduplicated Silver rows -> Silver table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia import fixed_values as V
from vacancia import schemas as S
from vacancia.context import RunContext, materialize
from vacancia.functions.classify import employment_type, qualification, work_mode
from vacancia.functions.dates import parse_ts
from vacancia.functions.ids import job_id
from vacancia.functions.text import clean_html, clean_or, map_city
from vacancia.operators.dedup import latest_by
from vacancia.operators.quality import (
    BUSINESS_KEYS,
    duplicate_groups,
    enforce,
    heal_duplicates,
    silver_checks,
)
from vacancia.operators.validate import require_rows, split_valid
from vacancia.sources.tables import (
    append_once,
    read_batch,
    read_batches,
    read_keyed,
    read_table,
    register_batch,
    registered_batches,
    replace_batches,
    replace_table,
    upsert_table,
)

DEDUP_KEYS = ["job_title", "company_name", "city"]


def latest_first() -> list[Column]:
    return [F.col("collected_at").desc_nulls_last(), F.col("job_id").asc(), F.col("job_url").asc()]


def with_dates(df: DataFrame, now: str) -> DataFrame:
    """Both dates as text; a missing scrape time is now, a missing posting date the scrape time."""
    dated = df.withColumn("collected_at", F.coalesce(parse_ts(F.col("raw_collected_at")), F.lit(now)))
    return dated.withColumn("posted_date", F.coalesce(parse_ts(F.col("raw_posted_date")), "collected_at"))


def drop_out_of_scope(df: DataFrame) -> DataFrame:
    return df.filter(
        ~(F.col("job_url").contains(V.OUT_OF_SCOPE_URL) | F.col("city").isin(V.OUT_OF_SCOPE_CITIES))
    )


def standardize(valid: DataFrame, now: str) -> DataFrame:
    """Valid Bronze rows as Silver rows, one for one except those out of scope."""
    raw = F.col
    staged = with_dates(valid, now).select(
        "source",
        clean_html(raw("raw_job_title")).alias("job_title"),
        clean_or(raw("raw_company_name"), V.NOT_SPECIFIED).alias("company_name"),
        clean_or(raw("raw_job_description"), V.NOT_SPECIFIED).alias("job_description"),
        F.trim("raw_job_url").alias("job_url"),
        F.lit(V.COUNTRY).alias("country"),
        map_city(raw("raw_city")).alias("city"),
        work_mode(raw("raw_work_mode")).alias("work_mode"),
        employment_type(raw("raw_employment_type")).alias("employment_type"),
        clean_or(raw("raw_experience"), V.UNKNOWN).alias("experience_needed"),
        qualification(raw("raw_qualification")).alias("qualification_required"),
        clean_or(raw("raw_skills"), V.NOT_SPECIFIED).alias("skills"),
        clean_or(raw("raw_salary"), V.NOT_SPECIFIED).alias("salary"),
        clean_or(raw("raw_estimated_salary"), V.NOT_SPECIFIED).alias("estimated_salary"),
        "posted_date",
        "collected_at",
    )
    scoped = drop_out_of_scope(staged)
    return scoped.withColumn("job_id", job_id(F.col("source"), F.col("job_url"), F.col("job_title")))


def deduplicate(staged: DataFrame) -> DataFrame:
    """Latest row per business key, then per id: the upsert needs each id once.

    The id comes second so that its shuffle also serves the upsert's join.
    """
    return latest_by(latest_by(staged, DEDUP_KEYS, latest_first()), ["job_id"], latest_first())


def to_silver(df: DataFrame) -> DataFrame:
    return df.select(*S.SILVER_COLUMNS)


def silver_batch(bronze: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Silver rows of a Bronze batch, and its rejected rows."""
    valid, rejected = split_valid(bronze)
    return to_silver(deduplicate(standardize(valid, now))), rejected


def load_silver(
    spark: SparkSession, bronze: str, silver: str, rejected: str, ctx: RunContext, buckets: int = 64
) -> dict[str, int]:
    """One Bronze batch into Silver: rejects kept, rows upserted. May be repeated.

    Gives out how many rows were inserted, updated and rejected, without a second run over the batch.
    """
    batch = require_rows(read_batch(read_table(spark, bronze, S.BRONZE), ctx), f"batch {ctx.batch_id}")
    rows, rejects = silver_batch(batch, ctx.now)
    append_once(rejects, rejected, ctx)
    counts = upsert_table(spark, silver, rows, ["job_id"], buckets)
    return {**counts, "rejected": read_batch(read_table(spark, rejected, S.REJECTED), ctx).count()}  # by file footers


def load_pending(
    spark: SparkSession, bronze: str, silver: str, rejected: str, ctx: RunContext, buckets: int = 64
) -> list[str]:
    """Every registered Bronze batch that is not in Silver yet, in one upsert; their ids are given out.

    Bronze is what `load_landing` wrote. Batches count as loaded once their rows are in Silver; a run
    that breaks off before that is repeated by the next one. Rejects stay in the batch they came with.
    """
    loaded = registered_batches(spark, silver).select("batch_id")
    pending = registered_batches(spark, bronze).join(loaded, "batch_id", "left_anti")
    batches = sorted((r["load_date"], r["batch_id"]) for r in pending.collect())  # batches, not rows
    if batches:
        rows = read_batches(read_table(spark, bronze, S.BRONZE), batches)
        good, rejects = silver_batch(rows, ctx.now)
        replace_batches(rejects, rejected)
        upsert_table(spark, silver, good, ["job_id"], buckets)
        for _, batch in batches:
            register_batch(spark, silver, replace(ctx, batch_id=batch))
    return [batch for _, batch in batches]


def gate_silver(spark: SparkSession, silver: str, buckets: int = 64) -> DataFrame:
    """Heal business-key duplicates, then run the checks and raise if one fails.

    The checks run once, and again only if something was healed.
    """
    table = read_keyed(spark, silver, S.SILVER)
    checks = materialize(silver_checks(table))
    enforce(checks.filter(F.col("check").isin("nonempty", "unique:job_id")))
    if not duplicate_groups(table, BUSINESS_KEYS).isEmpty():
        replace_table(spark, silver, heal_duplicates(table), ["job_id"], buckets)
        checks = materialize(silver_checks(read_keyed(spark, silver, S.SILVER)))
    enforce(checks)
    return checks
