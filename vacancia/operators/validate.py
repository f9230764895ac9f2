"""Input validation: rules, routing, and the non-empty assertion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vacancia.functions.text import country_ok, is_present, not_blank

REASONS = "reject_reasons"


def input_rules() -> dict[str, Column]:
    """Rule name -> condition. A condition is never null, so valid and rejected add up."""
    return {
        "title": is_present(F.col("raw_job_title")),
        "url": not_blank(F.col("raw_job_url")),
        "source": not_blank(F.col("source")),
        "description": is_present(F.col("raw_job_description")),
        "collected_at": not_blank(F.col("raw_collected_at")),
        "country": country_ok(F.col("raw_country")),
    }


def with_reject_reasons(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Adds the names of the rules a row fails."""
    rules = input_rules() if rules is None else rules
    failed = [F.when(~rule, F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(REASONS, F.array_compact(F.array(*failed)))


def split_valid(df: DataFrame, rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reasons."""
    rules = input_rules() if rules is None else rules
    valid = F.lit(True)
    for rule in rules.values():
        valid = valid & rule
    return df.filter(valid), with_reject_reasons(df.filter(~valid), rules)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason; a row counts once for each of its reasons."""
    return rejected.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows")
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The same rows; raises if there are none. Looks at one row only."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts rows while they are written, without a job of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
