"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under the order; remaining ties are settled by all other columns.

    Spark limits each key to one row per map task before the shuffle (WindowGroupLimit), so a key
    that holds a large share of the rows does not end up in one task.
    """
    ties = [
        F.col(f"`{f.name}`").asc_nulls_first()
        for f in df.schema.fields
        if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
