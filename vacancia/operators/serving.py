"""Serving queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia import fixed_values as V

NEWEST_FIRST = ["posted_date_key", "job_id"]


def serving_view(fact: DataFrame, dims: dict[str, DataFrame], ordered: bool = True) -> DataFrame:
    """Flat postings with a URL, newest first.

    The id completes the sort key: a day that holds many postings still spreads over tasks.
    """
    view = (
        fact.filter(F.col("job_url").isNotNull())
        .join(dims["job"].select("job_key", "job_title"), "job_key", "left")
        .join(dims["company"].select("company_key", "company_name"), "company_key", "left")
        .join(dims["location"].select("location_key", "city"), "location_key", "left")
        .join(dims["source"].select("source_key", "source_name"), "source_key", "left")
        .select("job_url", "job_id", "job_title", "company_name", "city", "source_name", "posted_date_key")
    )
    if not ordered:
        return view
    return view.orderBy(F.col("posted_date_key").desc_nulls_last(), F.col("job_id").asc())


# What demand is counted by -> key and name column of its dimension.
DEMAND_BY = {
    "city": ("location", "location_key", "city"),
    "company": ("company", "company_key", "company_name"),
    "source": ("source", "source_key", "source_name"),
    "skill": ("skill", "skill_key", "skill_name"),
}


def demand(fact: DataFrame, dims: dict[str, DataFrame], by: str, links: DataFrame | None = None) -> DataFrame:
    """Postings and distinct companies per city, company, source or skill.

    Facts are reduced to counts per pair of keys before names are joined, so neither a shared key
    nor its name travels once per posting. Postings without a member count under `V.NO_MEMBER`.
    """
    dim, key, name = DEMAND_BY[by]
    rows = fact.select("job_posting_key", "company_key", "location_key", "source_key")
    if by == "skill":
        rows = rows.join(links, "job_posting_key", "left")
    pairs = rows.groupBy(*dict.fromkeys([key, "company_key"])).agg(F.count(F.lit(1)).alias("_n"))
    named = pairs.join(dims[dim].select(key, name), key, "left").withColumn(name, F.coalesce(name, F.lit(V.NO_MEMBER)))
    return named.groupBy(name).agg(
        F.sum("_n").alias("postings"), F.count_distinct("company_key").alias("companies")
    )


def browse(view: DataFrame, city: str | None = None, source: str | None = None, text: str | None = None) -> DataFrame:
    """Postings of a city, of a source (a pattern), or with a text in title or company, ignoring case.

    The text is taken as it is: `%` and `_` stand for themselves.
    """
    if city is not None:
        view = view.filter(F.col("city") == city)
    if source is not None:
        view = view.filter(F.col("source_name").ilike(source))
    if text is not None:
        part = F.lower(F.lit(text))
        view = view.filter(F.contains(F.lower("job_title"), part) | F.contains(F.lower("company_name"), part))
    return view


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return counts.orderBy(F.col("n").desc(), F.col(key).asc())


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    result, *rest = counts
    for df in rest:
        result = result.unionByName(df)
    return result


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
