"""JSON sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.context import materialize


def export_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line; nulls are written out, non-ASCII text stays readable."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def json_array_lines(df: DataFrame, order: list[Column], record: Column | None = None) -> DataFrame:
    """Lines that, read in order, form one JSON array of the rows, or of what `record` renders of each."""
    if record is None:
        record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    ordered = df.orderBy(*order).select(record.alias("_json"), F.monotonically_increasing_id().alias("_line"))
    # The first line must stay the first one: number once, keep the numbers.
    ordered = materialize(ordered)
    first = ordered.agg(F.min("_line")).first()[0]
    lead = F.when(F.col("_line") == F.lit(first), "[").otherwise(",")
    lines = ordered.select(F.concat(lead, "_json").alias("value"))
    closing = df.sparkSession.range(1).select(F.lit("]" if first is not None else "[]").alias("value"))
    return lines.union(closing)


def export_json_array(df: DataFrame, path: str, order: list[Column]) -> None:
    """One JSON array spread over part files; their concatenation in name order is the document.

    Rows are sorted, rendered and written by all tasks; `order` should end in a unique column so
    that no single value's rows have to stay together.
    """
    json_array_lines(df, order).write.mode("overwrite").text(path)


def write_checkpoint(urls: DataFrame, path: str) -> None:
    """The distinct non-empty URLs as one sorted JSON list, which `read_checkpoint` reads; spread over part files."""
    known = urls.select("url").filter(F.col("url") != "").distinct()
    listed = F.to_json(F.array("url"))
    text = F.substring(listed, F.lit(2), F.length(listed) - 2)
    json_array_lines(known, [F.col("url").asc()], text).write.mode("overwrite").text(path)
