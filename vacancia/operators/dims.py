"""Incremental dimensional load: dimensions, facts, the skill bridge and the watermark."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia import fixed_values as V
from vacancia.functions.arrays import split_skills
from vacancia.functions.dates import date_key
from vacancia.operators.keys import assign_keys, assign_keys_apart, assign_keys_by, next_start
from vacancia.operators.merge import merge_upsert, missing_from, rows_with_keys_of
from vacancia.schemas import JOB_ATTRIBUTES

FACT_KEY = ["source_key", "job_id"]


# --- increment ----------------------------------------------------------------------------------


def since(df: DataFrame, ts_col: str, watermark: datetime | None, lookback: timedelta = timedelta(0)) -> DataFrame:
    """Rows stamped after the watermark; all rows if there is none yet.

    Stamps kept as text are compared as text of the same form, so the filter reaches the scan.
    """
    if watermark is None:
        return df
    limit = watermark - lookback
    if dict(df.dtypes)[ts_col] == "string":
        return df.filter(F.col(ts_col) > limit.strftime("%Y-%m-%d %H:%M:%S"))
    return df.filter(F.col(ts_col) > F.lit(limit))


def read_watermark(control: DataFrame, pipeline: str = V.PIPELINE_NAME) -> datetime | None:
    rows = control.filter(F.col("pipeline_name") == pipeline).agg(F.max("last_loaded_at"))
    return rows.first()[0]


def advance_watermark(control: DataFrame, df: DataFrame, ts_col: str, pipeline: str = V.PIPELINE_NAME) -> DataFrame:
    """The control table with the highest stamp processed; unchanged if there is none."""
    stamp = F.max(F.col(ts_col)).try_cast("timestamp")
    new = df.agg(stamp.alias("last_loaded_at")).filter(F.col("last_loaded_at").isNotNull())
    new = new.select(F.lit(pipeline).alias("pipeline_name"), "last_loaded_at")
    return merge_upsert(control, new, ["pipeline_name"], set_cols=["last_loaded_at"])


def col_or_default(df: DataFrame, name: str, default: str | None = V.NOT_AVAILABLE, cast: str = "string") -> Column:
    """An optional column with nulls filled, or the default alone if the table lacks it."""
    fill = F.lit(default).cast(cast)
    return F.coalesce(F.col(name).try_cast(cast), fill) if name in df.columns else fill


def prepare(silver: DataFrame, *others: str) -> DataFrame:
    """Silver rows with the optional columns the star schema knows, and others if named."""
    return silver.select(
        "job_id", "source", "job_title", "company_name", "job_url", "country", "city", "work_mode",
        "employment_type", "qualification_required", "skills",
        col_or_default(silver, "job_category").alias("job_category"),
        col_or_default(silver, "career_level").alias("career_level"),
        col_or_default(silver, "experience_needed").alias("experience_needed"),
        col_or_default(silver, "unified_job_id", None, "int").alias("unified_job_id"),
        col_or_default(silver, "industry", None).alias("industry"),
        F.col("salary").cast("string").alias("salary"),
        F.col("estimated_salary").cast("string").alias("estimated_salary"),
        "posted_date",
        *others,
    )


# --- dimensions ---------------------------------------------------------------------------------


def dim_members(df: DataFrame, cols: list[str], keep_null: bool = False) -> DataFrame:
    """Distinct combinations; rows with a null in them only if asked for."""
    picked = df.select(*cols)
    if not keep_null:
        picked = picked.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return picked.distinct()


def new_members(
    dim: DataFrame, members: DataFrame, natural: list[str], key: str, null_safe: bool = False
) -> DataFrame:
    """Members the dimension does not hold yet, with the next free keys in natural order."""
    fresh = missing_from(members, dim, natural, null_safe)
    keyed = assign_keys(fresh, natural, key, next_start(dim, key))
    columns = [
        (F.col(f.name) if f.name in keyed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in dim.schema.fields
    ]
    return keyed.select(*columns)


def extend_dim(
    dim: DataFrame, members: DataFrame, natural: list[str], key: str, null_safe: bool = False
) -> DataFrame:
    """The dimension with new members appended; existing keys never change."""
    return dim.unionByName(new_members(dim, members, natural, key, null_safe))


# Dimensions with a surrogate key: natural key in the dimension -> column of the prepared rows.
NATURAL = {
    "source": {"source_name": "source"},
    "company": {"company_name": "company_name"},
    "location": {"country": "country", "city": "city"},
    "job": {c: c for c in JOB_ATTRIBUTES},
}
# Their natural keys may hold nulls, which are values like others.
NULL_SAFE = {"location", "job"}
_NATURAL_COLUMNS = [c for pairs in NATURAL.values() for c in pairs]


def all_members(prepared: DataFrame, stamp: str) -> DataFrame:
    """Members of all dimensions but skills, and days, from one pass over the rows and one shuffle.

    One row per member: the `dimension`, its natural key (columns of other dimensions are null), one
    of a company's industries, the `day`, and the highest stamp. Grouping sets count each
    row once per dimension, and equal members are combined before the shuffle.
    """
    columns = [F.col(c).alias(n) for pairs in NATURAL.values() for n, c in pairs.items()]
    rows = prepared.select(*columns, F.col("posted_date").try_cast("date").alias("day"), "industry", stamp)
    sets = {name: list(pairs) for name, pairs in NATURAL.items()} | {"date": ["day"]}
    grouped = [*_NATURAL_COLUMNS, "day"]
    found = rows.groupingSets([[F.col(c) for c in cols] for cols in sets.values()], *[F.col(c) for c in grouped]).agg(
        F.grouping_id().alias("_set"), F.min("industry").alias("industry"), F.max(stamp).alias("stamp")
    )
    name, held = F.lit(None).cast("string"), F.lit(False)
    for dimension, cols in sets.items():
        # A bit is set for each column that the grouping set leaves out, the first column highest.
        bits = sum(1 << (len(grouped) - 1 - i) for i, c in enumerate(grouped) if c not in cols)
        here = F.col("_set") == bits
        name = F.when(here, dimension).otherwise(name)
        filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        held = held | (here if dimension in NULL_SAFE else here & filled)
    return found.filter(held).select(name.alias("dimension"), *grouped, "industry", "stamp")


def new_keyed(members: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """New members of each dimension with the next free keys, all numbered by one sort.

    `members` is read once per dimension, so it should be materialized.
    """
    fresh = [
        missing_from(members.filter(F.col("dimension") == name), dims[name], list(pairs), name in NULL_SAFE)
        for name, pairs in NATURAL.items()
    ]
    highest = [
        dims[name].agg(F.max(f"{name}_key").alias("top")).select(F.lit(name).alias("name"), "top") for name in NATURAL
    ]
    starts = {row["name"]: row["top"] or 0 for row in reduce(DataFrame.unionByName, highest).collect()}
    keyed = assign_keys_by(reduce(DataFrame.unionByName, fresh), "dimension", _NATURAL_COLUMNS, "_key", starts)

    def columns(name: str) -> list[Column]:
        return [
            F.col("_key" if f.name == f"{name}_key" else f.name).cast(f.dataType).alias(f.name)
            for f in dims[name].schema.fields
        ]

    return {name: keyed.filter(F.col("dimension") == name).select(*columns(name)) for name in NATURAL}


def company_members(df: DataFrame) -> DataFrame:
    """Distinct companies with one of their industries, where the source has any."""
    return df.filter(F.col("company_name").isNotNull()).groupBy("company_name").agg(
        F.min("industry").alias("industry")
    )


def dim_date(df: DataFrame, col: str) -> DataFrame:
    """One row per calendar day found."""
    days = df.select(F.col(col).try_cast("date").alias("date")).filter(F.col("date").isNotNull()).distinct()
    return days.select(
        date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.quarter("date").alias("quarter"),
        F.date_format("date", "EEEE").alias("day_of_week"),
    )


# --- facts --------------------------------------------------------------------------------------


BROADCAST_BYTES = 64 << 20


def broadcast_small(tables: dict[str, DataFrame], limit: int = BROADCAST_BYTES) -> dict[str, DataFrame]:
    """Marks each table for broadcast if its measured size allows; Spark joins the others by shuffle.

    Keys given out in this very load have no file size Spark could go by, so the size is counted,
    for all tables in one job: the bytes of all texts and 16 more per value.
    """

    def size(name: str, df: DataFrame) -> DataFrame:
        texts = [F.coalesce(F.octet_length(n), F.lit(0)) for n, t in df.dtypes if t == "string"]
        width = reduce(lambda a, b: a + b, texts, F.lit(16 * len(df.columns))).cast("bigint")
        return df.agg(F.sum(width).alias("bytes")).select(F.lit(name).alias("name"), "bytes")

    measured = reduce(DataFrame.unionByName, [size(n, df) for n, df in tables.items()])
    sizes = {row["name"]: row["bytes"] or 0 for row in measured.collect()}
    return {n: F.broadcast(df) if sizes[n] <= limit else df for n, df in tables.items()}


def resolve_keys(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact candidates: natural values replaced by the keys of `source`, `company`, `location`, `job`.

    Dimensions of a small measured size are broadcast; larger ones join by shuffle, where a value
    many rows share is split by the adaptive skew join.
    """
    p = df.alias("p")
    lookups = broadcast_small(
        {
            "source": dims["source"].select("source_key", "source_name"),
            "company": dims["company"].select("company_key", F.col("company_name").alias("_company")),
            "location": dims["location"].select(
                "location_key", F.col("country").alias("_country"), F.col("city").alias("_city")
            ),
            "job": dims["job"].select("job_key", *[F.col(c).alias(f"_{c}") for c in JOB_ATTRIBUTES]),
        }
    )
    null_safe = {"job_category", "career_level", "experience_needed"}
    same_job = [
        F.col(f"p.{c}").eqNullSafe(F.col(f"_{c}")) if c in null_safe else F.col(f"p.{c}") == F.col(f"_{c}")
        for c in JOB_ATTRIBUTES
    ]
    return (
        p.join(lookups["source"], F.col("p.source") == F.col("source_name"), "left")
        .join(lookups["company"], F.col("p.company_name") == F.col("_company"), "left")
        .join(
            lookups["location"],
            (F.col("p.country") == F.col("_country")) & (F.col("p.city") == F.col("_city")),
            "left",
        )
        .join(lookups["job"], reduce(lambda a, b: a & b, same_job), "left")
        .select(
            "job_key", "company_key", "location_key", "source_key",
            date_key(F.col("p.posted_date")).alias("posted_date_key"),
            "job_id", "unified_job_id", "job_url", "salary", "estimated_salary", "skills",
        )
    )


def new_facts(candidates: DataFrame, fact: DataFrame) -> DataFrame:
    """Candidates the fact table does not hold."""
    known = rows_with_keys_of(fact.select(*FACT_KEY), candidates, FACT_KEY)
    return candidates.join(known, FACT_KEY, "left_anti").select(*candidates.columns)


def to_fact(new: DataFrame, row: str, start: int = 0) -> DataFrame:
    """Fact rows with their own key; `skills` rides along for the bridge. `row` numbers the given rows."""
    return assign_keys_apart(new, row, FACT_KEY, "job_posting_key", start).select(
        "job_posting_key", "job_key", "job_id", "unified_job_id", "company_key", "location_key",
        "source_key", "posted_date_key", F.lit(None).cast("int").alias("source_job_key"),
        "job_url", "salary", F.col("estimated_salary").alias("AI_salary"), "skills",
    )


# --- skills -------------------------------------------------------------------------------------


def explode_skills(df: DataFrame, col: str = "skills") -> DataFrame:
    """One row per distinct skill of each row."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode(split_skills(F.col(col), V.NOT_SPECIFIED)).alias("skill_name"))


def bridge(skills: DataFrame, dim_skill: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Posting-skill links of rows (`job_posting_key`, `skill_name`); links that exist are left out.

    A posting has its own key and lists each skill once, so the links are distinct as they are.
    """
    names = broadcast_small({"skill": dim_skill.select("skill_key", "skill_name")})
    links = skills.join(names["skill"], "skill_name").select("job_posting_key", "skill_key")
    if existing is None:
        return links
    keys = ["job_posting_key", "skill_key"]
    return links.join(rows_with_keys_of(existing, links, keys), keys, "left_anti")
