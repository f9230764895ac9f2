"""Merges built from joins. `source` holds each key once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _match(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    tests = [
        left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in keys
    ]
    return reduce(lambda a, b: a & b, tests)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], set_cols: list[str] | None = None
) -> DataFrame:
    """Matched rows are replaced, unmatched ones inserted.

    With `set_cols` a matched row takes only those columns from the source and keeps the rest.
    """
    if set_cols is None:
        return target.join(source.select(*keys), keys, "left_anti").unionByName(source)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")

    def pick(name: str) -> Column:
        if name not in source.columns:
            return F.col(f"t.{name}")
        from_source = F.col("t._in_target").isNull()
        if name in set_cols:
            from_source = F.col("s._in_source").isNotNull()
        return F.when(from_source, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))

    return joined.select(*[pick(c).alias(c) for c in target.columns])


def missing_from(source: DataFrame, target: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Source rows whose key the target does not hold."""
    known = target.select(*keys)
    return source.join(known, _match(source, known, keys, null_safe), "left_anti")


def merge_insert(
    target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False
) -> DataFrame:
    """Unmatched rows are inserted, matched ones stay as they are."""
    fresh = missing_from(source, target, keys, null_safe)
    return target.unionByName(fresh, allowMissingColumns=True)


def rows_with_keys_of(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key occurs in the source.

    With an increment as source this cuts a large target down before any further join: the target
    is streamed past the increment's keys, and shuffled only if those are too many to broadcast.
    """
    return target.join(source.select(*keys), keys, "left_semi")


def merge_metrics(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows an upsert would insert and update."""
    known = rows_with_keys_of(target.select(*keys), source, keys).withColumn("_known", F.lit(True))
    return source.select(*keys).join(known, keys, "left").agg(
        F.count_if(F.col("_known").isNull()).alias("rows_inserted"),
        F.count_if(F.col("_known").isNotNull()).alias("rows_updated"),
    )
