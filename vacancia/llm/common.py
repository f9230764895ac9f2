"""Shared storage, measured broadcasts and session settings for the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.context import configure, shared_folder

#: A side is broadcast only if its counted rows times their width stay below this.
BROADCAST_BYTES = 32 << 20


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under spark.checkpoint.dir; executors and driver share it."""
    configure(spark)
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str) -> DataFrame:
    """Write once and go on from the files: lineage is cut on storage that outlives executors."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small(df: DataFrame, width: int) -> DataFrame:
    """Broadcast a stored table if its counted size is small; otherwise the join shuffles it.

    `width` bounds the bytes of a row. The adaptive skew join splits hot keys of a shuffled join.
    """
    return F.broadcast(df) if df.count() * width <= BROADCAST_BYTES else df


def small_by(df: DataFrame, size) -> DataFrame:
    """The same by a measured sum of bytes, for rows of no fixed width; `size` is a column."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch: bounds what a Python worker holds of a table of long texts.
BATCH_ROWS = 2000


def texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key as long, text as UTF-8 bytes, null as empty) for a task in Python; all else is pruned."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    )


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """So many rows to an Arrow batch in the jobs run inside; the caller's setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
