"""Quality checks: each is one row `check, passed, violations`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia import fixed_values as V
from vacancia.functions.text import not_blank
from vacancia.operators.dedup import latest_by

MANDATORY = ["job_id", "source", "job_title", "job_url", "country", "job_description", "collected_at"]
BUSINESS_KEYS = ["job_title", "company_name", "city", "posted_date"]


class QualityError(AssertionError):
    """A check of the gate failed."""


def _report(df: DataFrame, violations: dict[str, Column]) -> DataFrame:
    """All checks of a table in one pass: one aggregate, then one row per check."""
    names = list(violations)
    counted = df.agg(
        *[F.coalesce(v, F.lit(0)).cast("bigint").alias(f"v{i}") for i, v in enumerate(violations.values())]
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("check"), F.col(f"v{i}").alias("violations")) for i, n in enumerate(names)]
    )
    return counted.select(F.inline(rows)).select(
        "check", (F.col("violations") == 0).alias("passed"), "violations"
    )


def _no_rows() -> Column:
    return F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)


def _repeats(key: str) -> Column:
    """Rows beyond the first of each value; null is a value."""
    return F.count(F.lit(1)) - F.count_distinct(F.col(key)) - F.when(F.count_if(F.col(key).isNull()) > 0, 1).otherwise(0)


def _blanks(col: str) -> Column:
    return F.count_if(~not_blank(F.col(col)))


def _outside(col: str, values: list[str]) -> Column:
    return F.count_if(~F.col(col).isin(values))


def check_nonempty(df: DataFrame, name: str = "nonempty") -> DataFrame:
    return _report(df, {name: _no_rows()})


def check_unique(df: DataFrame, key: str) -> DataFrame:
    return _report(df, {f"unique:{key}": _repeats(key)})


def check_not_blank(df: DataFrame, cols: list[str]) -> DataFrame:
    return _report(df, {f"not_blank:{c}": _blanks(c) for c in cols})


def check_domain(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    return _report(df, {f"domain:{col}": _outside(col, values)})


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_pk(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Key columns are filled and no key repeats; violations are keys, not rows."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _report(groups, {f"pk:{name}": F.count_if((F.col("n") > 1) | any_null)})


def check_fk(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose non-null key the dimension does not hold.

    Keys are counted before the join, so a key that many rows share crosses the shuffle once.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    held = dim.select(F.col(dim_key or key).alias(key))
    return _report(used.join(held, key, "left_anti"), {f"fk:{key}": F.sum("n")})


def heal_duplicates(
    df: DataFrame, keys: list[str] | None = None, order: list[Column] | None = None
) -> DataFrame:
    """Only the latest row of each business key."""
    return latest_by(df, keys or BUSINESS_KEYS, order or [F.col("collected_at").desc()])


def silver_checks(silver: DataFrame) -> DataFrame:
    """The whole Silver gate in one pass over the table."""
    return _report(
        silver,
        {
            "nonempty": _no_rows(),
            "unique:job_id": _repeats("job_id"),
            **{f"not_blank:{c}": _blanks(c) for c in MANDATORY},
            "domain:country": _outside("country", [V.COUNTRY]),
        },
    )


def enforce(checks: DataFrame) -> None:
    """Raise if any check failed; the table of checks has one row per check."""
    failed = [f"{r['check']} ({r['violations']})" for r in checks.collect() if not r["passed"]]
    if failed:
        raise QualityError("failed checks: " + ", ".join(failed))
