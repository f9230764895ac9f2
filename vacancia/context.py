"""Run context, session set-up and lineage cutting."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@dataclass(frozen=True)
class RunContext:
    """One immutable set of run values shared by every step of a run."""

    load_date: str
    batch_id: str
    now: str

    @classmethod
    def create(cls, load_date: str = "", batch_id: str = "", now: datetime | None = None) -> RunContext:
        """Parameters win; blank ones fall back to one reading of the clock (UTC)."""
        clock = now or datetime.now(timezone.utc)
        load_date = (load_date or "").strip() or clock.strftime("%Y-%m-%d")
        batch_id = (batch_id or "").strip() or clock.strftime("%Y%m%d_%H%M%S")
        datetime.strptime(load_date, "%Y-%m-%d")
        if not re.fullmatch(r"[A-Za-z0-9_.\-]+", batch_id):
            raise ValueError(f"batch id must be letters, digits, '_', '.' or '-': {batch_id!r}")
        return cls(load_date, batch_id, clock.strftime("%Y-%m-%d %H:%M:%S"))


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (time zone) and the adaptive ones skew depends on."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    # Named files are listed by a job whenever they are read: by a few tasks a core, not by one task a file.
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the executors, whose Python tasks import them by name."""
    context = spark.sparkContext
    if getattr(context, "_vacancia_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="vacancia-")), "vacancia.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.join("vacancia", os.path.relpath(file, root)))
    context.addPyFile(path)
    context._vacancia_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local session may fall back to its own."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="vacancia-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, on storage that survives the loss of executors."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores if there are fewer input splits than that; unchanged otherwise.

    For scans whose rows cost far more to process than to move, such as pages in one small file.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
