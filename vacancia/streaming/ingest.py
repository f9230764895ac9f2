"""Landing folder -> Bronze -> Silver as streams; each file is read once."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vacancia.context import RunContext
from vacancia.plans.bronze import SHAPES, any_case, lost_pieces
from vacancia.plans.silver import silver_batch
from vacancia.sources.landing import RECORD_SEPARATOR, parse_pieces, read_pieces
from vacancia.sources.tables import append_once, register_batch, upsert_table, with_ingest_metadata, write_batch


def piece_stream(
    spark: SparkSession, landing: str, pattern: str, archive: str | None = None, max_files: int = 1000
) -> DataFrame:
    """Pieces of landed files whose name fits the pattern, as a stream, each with its file.

    All pieces of a file arrive in one micro-batch. Files that are not indented by two are one piece.
    Which files were read is kept by the query's checkpoint. With `archive` Spark moves finished
    files there, one batch later; the folder must lie outside the landing folder.
    """
    reader = (
        spark.readStream.format("text")
        .option("lineSep", RECORD_SEPARATOR)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(landing).select("value", F.col("_metadata.file_path").alias("_source_file"))


def file_stream(
    spark: SparkSession, landing: str, pattern: str, archive: str | None = None, max_files: int = 1000
) -> DataFrame:
    """Paths of landed files whose name fits the pattern, as a stream; no content is read."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(landing).select("path")


def literal_path(path: str) -> str:
    """A path that means itself where patterns are allowed."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    pattern: str,
    archive: str | None = None,
    max_files: int = 1000,
) -> DataFrame:
    """Records of landed files; unreadable pieces are kept in `_corrupt_record`."""
    return parse_pieces(piece_stream(spark, landing, pattern, archive, max_files), schema)


def _files_of(prefix: str) -> str:
    return f"{any_case(prefix)}*.[jJ][sS][oO][nN]"


def bronze_stream(
    spark: SparkSession, landing: str, prefix: str, archive: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Records of one source in the Bronze columns; the stream stops at a piece that cannot be read.

    `load_landing` puts such pieces aside instead, and also reports files that were cut off.
    """
    schema, mapping = SHAPES[prefix]
    raw = ingest_stream(spark, landing, schema, pattern or _files_of(prefix), archive)
    stop = F.raise_error(F.concat(F.lit("landed file cannot be read: "), F.col("_source_file"))).cast("boolean")
    return mapping(raw.filter(F.when(F.col("_corrupt_record").isNull(), F.lit(True)).otherwise(stop)))


def _start(df: DataFrame, checkpoint: str, write) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _micro(spark: SparkSession, table: str, ctx: RunContext, name: str, epoch: int) -> RunContext:
    """A micro-batch is a batch of its own. Stream and epoch name it, not the run, and the table's register
    keeps its load date: a micro-batch that is replayed after a restart, on whatever day, replaces itself."""
    return register_batch(spark, table, replace(ctx, batch_id=f"{name}.{epoch}"))


def bronze_writer(rows: DataFrame, path: str, checkpoint: str, ctx: RunContext, name: str) -> StreamingQuery:
    """Write micro-batches to Bronze; a replayed micro-batch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        micro = _micro(batch.sparkSession, path, ctx, name, epoch)
        write_batch(with_ingest_metadata(batch, micro), path, micro)

    return _start(rows, checkpoint, write)


def load_landing(
    spark: SparkSession,
    landing: str,
    prefix: str,
    bronze: str,
    quarantine: str,
    checkpoint: str,
    ctx: RunContext,
    archive: str | None = None,
    pattern: str | None = None,
) -> StreamingQuery:
    """New landed files of one source into Bronze, what cannot be read into the quarantine table.

    The checkpoint knows the files of earlier runs: a run reads only what landed since, in any layout.
    Each micro-batch is one Bronze and one quarantine batch, and replaces itself when replayed.
    `plans.silver.load_pending` takes the batches on to Silver.
    """
    schema, mapping = SHAPES[prefix]

    def write(files: DataFrame, epoch: int) -> None:
        session = files.sparkSession
        # As many as a micro-batch may have. The source may name a file twice if another one's name is a pattern.
        paths = sorted({literal_path(r["path"]) for r in files.collect()})
        if not paths:
            return
        micro = _micro(session, bronze, ctx, prefix, epoch)
        pieces = read_pieces(session, paths)
        # Parsed once for both outputs; the files are still there should a cached part be lost.
        parsed = parse_pieces(pieces, schema).select(*schema.names, "_corrupt_record", "_source_file").persist()
        try:
            write_batch(with_ingest_metadata(lost_pieces(pieces, schema, parsed), micro), quarantine, micro)
            records = mapping(parsed.filter("_corrupt_record IS NULL"))
            write_batch(with_ingest_metadata(records, micro), bronze, micro)
        finally:
            parsed.unpersist()

    return _start(file_stream(spark, landing, pattern or _files_of(prefix), archive), checkpoint, write)


def upsert_stream(
    bronze: DataFrame,
    silver: str,
    rejected: str,
    checkpoint: str,
    ctx: RunContext,
    name: str = "stream",
    buckets: int = 64,
) -> StreamingQuery:
    """Validate, standardize and upsert micro-batches; both writes may be replayed."""

    def write(batch: DataFrame, epoch: int) -> None:
        micro = _micro(batch.sparkSession, rejected, ctx, name, epoch)
        # Both outputs read the micro-batch; its files are still there should a cached part be lost.
        cached = batch.persist()
        try:
            rows, rejects = silver_batch(with_ingest_metadata(cached, micro), ctx.now)
            append_once(rejects, rejected, micro)
            upsert_table(batch.sparkSession, silver, rows, ["job_id"], buckets)
        finally:
            cached.unpersist()

    return _start(bronze, checkpoint, write)


def dedup_stream(df: DataFrame, delay: str, key: str = "job_id", ts_col: str = "collected_ts") -> DataFrame:
    """Each key once within the delay; state older than the watermark is dropped."""
    return df.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key])
