"""Landing files: inventory, JSON-array postings, stored-file bookkeeping, URL checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia import fixed_values as V
from vacancia.context import materialize
from vacancia.operators.dedup import latest_by
from vacancia.sources.json_split import FILE_COLUMNS, fragments, split_records

# Most landing files hold one JSON array written with an indent of two, so the text between two records
# is always the same. Reading with that text as line separator lets Spark split one large file over
# many tasks without looking at it twice. Files that begin otherwise go to `json_split`.
RECORD_SEPARATOR = "\n  },\n  {"
#: White space at one place of a piece, taken whole: the patterns look at a piece's ends and never go back.
_SPACE = r"[\s\x{FEFF}]*+"
INDENTED = r"^\x{FEFF}?\[\n  \{\n"


def landing_files(
    spark: SparkSession,
    folder: str,
    prefixes: list[str] | None = None,
    suffix: str = ".json",
) -> DataFrame:
    """Files of a folder that belong to a source, by lower-cased name prefix. No content is read."""
    prefixes = V.FILE_PREFIXES if prefixes is None else prefixes
    name = F.substring_index("path", "/", -1)
    files = spark.read.format("binaryFile").load(folder).select(
        "path",
        name.alias("name"),
        "length",
        F.col("modificationTime").alias("mtime"),
        source_of_name(name, prefixes).alias("source"),
    )
    return files.filter(F.lower("name").endswith(suffix) & F.col("source").isNotNull())


def source_of_name(name: Column, prefixes: list[str]) -> Column:
    """The prefix a file name starts with, ignoring case; null if none."""
    return F.coalesce(*[F.when(F.lower(name).startswith(p), F.lit(p)) for p in prefixes])


def latest_per_source(files: DataFrame) -> DataFrame:
    """Only the last file of each source by name."""
    return latest_by(files, ["source"], [F.col("name").desc()])


def _array_text(piece: Column) -> Column:
    """A piece of an array file as an array of its own.

    Inner pieces lost their opening and closing brackets to the separator. The JSON functions stop
    at the end of the first value, so closing a piece that is already closed does no harm.
    """
    opened = piece.rlike(rf"\A{_SPACE}\[")
    return F.concat(F.when(opened, F.lit("")).otherwise(F.lit("[{")), piece, F.lit("}]"))


def _is_blank(piece: Column, closed: bool = True) -> Column:
    """White space alone, or with the bracket that closes the array."""
    return piece.rlike(rf"\A{_SPACE}{r'\]?+' * closed}{_SPACE}\z")


def parse_pieces(pieces: DataFrame, schema: T.StructType, text_col: str = "value") -> DataFrame:
    """Pieces of array files -> one row per record, unreadable pieces kept in `_corrupt_record`."""
    keep = [c for c in pieces.columns if c != text_col]
    blank = _is_blank(F.col(text_col))
    parsed = F.from_json(_array_text(F.col(text_col)), T.ArrayType(schema))
    # Filtered after the explode: a filter on the parsed array would parse every piece twice.
    return (
        pieces.filter(~blank)
        .select(*keep, text_col, parsed.alias("_records"))
        .select(
            *keep,
            F.when(F.col("_records").isNull(), F.col(text_col)).alias("_corrupt_record"),
            F.explode_outer("_records").alias("_record"),
        )
        .filter(F.col("_record").isNotNull() | F.col("_corrupt_record").isNotNull())
        .select("_record.*", "_corrupt_record", *keep)
    )


def layouts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """_source_file of every file with text, and whether it begins like an array `indented` by two."""
    first = fragments(spark, paths).filter("_block = 0").select(
        "_source_file",
        F.substring("value", 1, 64).cast("string").rlike(INDENTED).alias("indented"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return first.groupBy("_source_file").agg(F.min_by("indented", "_row").alias("indented"))


def read_pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Pieces of array files, a record or so each, with their file; every file is read by many tasks.

    The files' layouts are looked at when this is called.
    """
    seen = materialize(layouts(spark, paths))
    files = {row["indented"]: row["count"] for row in seen.groupBy("indented").count().collect()}
    if not files.get(False):
        return _separated(spark, paths)
    others = seen.filter("NOT indented").select("_source_file")
    if not files.get(True):
        return split_records(spark, paths)
    split = split_records(spark, paths, others, files[False])
    return _separated(spark, paths).join(others, "_source_file", "left_anti").select(*split.columns).unionByName(split)


def _separated(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return (
        spark.read.option("lineSep", RECORD_SEPARATOR)
        .text(paths)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_size").alias("_file_size"),
            F.col("_metadata.file_modification_time").alias("_file_mtime"),
        )
    )


def cut_off_files(pieces: DataFrame) -> DataFrame:
    """Files whose array is never closed: an upload that broke off."""
    # Most pieces are records: the pattern is tried at every place, so only where the bracket may stand.
    value = F.col("value")
    bracket = value.startswith("]") | value.contains("\n]") | value.contains("\r]")
    closed = bracket & value.rlike(r"(^|[\r\n])\][\s\x{FEFF}]*$")
    blank = _is_blank(F.col("value"), closed=False)
    files = pieces.filter(~blank).groupBy("_source_file").agg(F.bool_or(closed).alias("_whole"))
    return files.filter(~F.col("_whole")).select("_source_file")


def read_postings(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Records of JSON-array files under an explicit schema, with their file's name and size."""
    return parse_pieces(read_pieces(spark, paths), schema)


def file_record_counts(spark: SparkSession, paths: str | list[str], name_contains: str = "") -> DataFrame:
    """Records, size and time of every stored file, oldest first; empty files count zero."""
    in_name = F.lower(F.substring_index("_source_file", "/", -1)).contains(name_contains.lower())
    records = F.when(~_is_blank(F.col("value")), F.json_array_length(_array_text(F.col("value"))))
    counts = (
        read_pieces(spark, paths)
        .filter(in_name)
        .groupBy(*FILE_COLUMNS)
        .agg(F.sum(F.coalesce(records, F.lit(0))).alias("records"))
    )
    return counts.orderBy("_file_mtime", "_source_file")


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """The URL set stored as a JSON list of strings."""
    quoted = F.regexp_extract_all("value", F.lit(r'"(?:[^"\\]|\\.)*"'), F.lit(0))
    lines = spark.read.text(path).select(F.explode(quoted).alias("_q"))
    url = F.get_json_object(F.concat(F.lit("["), F.col("_q"), F.lit("]")), "$[0]")
    return lines.select(url.alias("url")).distinct()


def rebuild_checkpoint(*stored: DataFrame) -> DataFrame:
    """Sorted set of the non-empty URLs of all stored records."""
    first, *rest = [df.select("url") for df in stored]
    for df in rest:
        first = first.unionByName(df)
    return first.filter(F.col("url") != "").distinct().orderBy("url")
