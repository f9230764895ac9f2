"""Landing files -> Bronze batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia import fixed_values as V
from vacancia import schemas as S
from vacancia.context import RunContext
from vacancia.operators.unify import unify, unify_flat_a, unify_flat_b, unify_nested
from vacancia.sources.landing import (
    cut_off_files,
    file_record_counts,
    latest_per_source,
    parse_pieces,
    read_pieces,
    read_postings,
    source_of_name,
)
from vacancia.sources.tables import with_ingest_metadata, write_batch

# File prefix -> raw schema and mapping.
SHAPES = {
    V.FILE_PREFIXES[0]: (S.RAW_NESTED, unify_nested),
    V.FILE_PREFIXES[1]: (S.RAW_FLAT_A, unify_flat_a),
    V.FILE_PREFIXES[2]: (S.RAW_FLAT_B, unify_flat_b),
}


def landed_postings(spark: SparkSession, folder: str, latest_only: bool = False) -> DataFrame:
    """All landed records in the Bronze columns; empty if nothing has landed.

    Every file of a source is read; `latest_only` takes just the last one by name that holds records.
    """
    parts = [unify(spark.createDataFrame([], S.BRONZE))]
    for prefix, (schema, mapping) in SHAPES.items():
        try:
            paths = [landed_files(folder, prefix)]
            if latest_only:
                paths = [row["path"] for row in latest_file(spark, paths, prefix).collect()]  # at most one
            if not paths:
                continue
            raw = read_postings(spark, paths, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        parts.append(mapping(raw.filter("_corrupt_record IS NULL")))
    return unify(*parts)


def any_case(prefix: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" for c in prefix)


def landed_files(folder: str, prefix: str) -> str:
    return f"{folder}/{any_case(prefix)}*.[jJ][sS][oO][nN]"


def latest_file(spark: SparkSession, paths: list[str], prefix: str) -> DataFrame:
    """The last file of a source by name; files without records do not count."""
    name = F.substring_index("_source_file", "/", -1)
    files = file_record_counts(spark, paths).filter("records > 0")
    return latest_per_source(
        files.select(F.col("_source_file").alias("path"), name.alias("name"), source_of_name(name, [prefix]).alias("source"))
    )


def lost_pieces(pieces: DataFrame, schema: T.StructType, parsed: DataFrame | None = None) -> DataFrame:
    """_source_file, reason and text of what cannot be read as records: broken pieces, cut-off files.

    `parsed` is what `parse_pieces` made of the pieces, if it is at hand.
    """
    parsed = parse_pieces(pieces, schema) if parsed is None else parsed
    broken = parsed.filter("_corrupt_record IS NOT NULL")
    broken = broken.select("_source_file", F.lit("broken").alias("reason"), "_corrupt_record")
    cut = cut_off_files(pieces).select("_source_file", F.lit("cut off").alias("reason"))
    return broken.unionByName(cut, allowMissingColumns=True)


def unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """What landed but cannot be read, each source by its own schema: just what the load leaves out."""
    lost = spark.createDataFrame([], "_source_file string, reason string, _corrupt_record string")
    for prefix, (schema, _) in SHAPES.items():
        try:
            lost = lost.unionByName(lost_pieces(read_pieces(spark, landed_files(folder, prefix)), schema))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return lost


def load_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    ctx: RunContext,
    latest_only: bool = False,
    quarantine: str | None = None,
) -> None:
    """Write the landed records as one batch; a repeated run replaces the batch.

    What cannot be read goes to the `quarantine` table; without one the load stops before it writes.
    """
    lost = unreadable(spark, landing)
    if quarantine:
        write_batch(with_ingest_metadata(lost, ctx), quarantine, ctx)
    elif (first := lost.first()) is not None:
        raise ValueError(f"landed file cannot be read ({first['reason']}): {first['_source_file']}")
    rows = with_ingest_metadata(landed_postings(spark, landing, latest_only), ctx)
    write_batch(rows, bronze, ctx)
