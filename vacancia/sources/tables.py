"""Parquet tables: batch writes that can be repeated, appends, creation, and the keyed upsert."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia.context import RunContext, materialize
from vacancia.operators.merge import merge_upsert, rows_with_keys_of

BUCKET = "_bucket"


def with_ingest_metadata(df: DataFrame, ctx: RunContext) -> DataFrame:
    return (
        df.withColumn("_ingest_ts", F.current_timestamp())
        .withColumn("_load_date", F.lit(ctx.load_date).cast("date"))
        .withColumn("_batch_id", F.lit(ctx.batch_id))
    )


def write_batch(df: DataFrame, path: str, ctx: RunContext) -> None:
    """Write the rows of one batch. Repeating the batch replaces its rows and no others.

    The batch's own folder is overwritten, so an empty rerun empties the batch too.
    """
    rows = df.drop("_load_date", "_batch_id").hint("rebalance")
    rows.write.mode("overwrite").parquet(f"{path}/_load_date={ctx.load_date}/_batch_id={ctx.batch_id}")


append_once = write_batch


# Batches of a table and the load date each was first written under.
BATCHES = T.StructType([T.StructField("load_date", T.StringType()), T.StructField("batch_id", T.StringType())])


def register_batch(spark: SparkSession, path: str, ctx: RunContext) -> RunContext:
    """The context to write a batch of the table under: its load date is the one of the first attempt.

    The register lies beside the table, one record per batch. A batch that is written again on a later
    day, because its first run broke off, so replaces what that run left. One writer per batch.
    """
    place = f"{path.rstrip('/')}__batches/{ctx.batch_id}"
    held = read_table(spark, place, BATCHES).first()
    if held is None:
        row = spark.createDataFrame([(ctx.load_date, ctx.batch_id)], BATCHES)
        row.coalesce(1).write.mode("overwrite").parquet(place)
        return ctx
    return replace(ctx, load_date=held["load_date"])


def registered_batches(spark: SparkSession, path: str) -> DataFrame:
    """BATCHES of a table."""
    try:
        return spark.read.schema(BATCHES).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}__batches")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BATCHES)


def read_batches(df: DataFrame, batches: list[tuple[str, str]]) -> DataFrame:
    """Rows of several batches (load date, id); on a table of batches only their folders are read."""
    days, ids = {d for d, _ in batches}, {i for _, i in batches}
    pairs = F.struct(F.col("_load_date").cast("string"), "_batch_id").isin(
        *[F.struct(F.lit(d), F.lit(i)) for d, i in batches]
    ) if batches else F.lit(False)
    folders = F.col("_load_date").isin(*[F.lit(d).cast("date") for d in days]) & F.col("_batch_id").isin(*ids)
    return df.filter(folders).filter(pairs)


def replace_batches(df: DataFrame, path: str) -> None:
    """Write rows that carry their batch; the batches among them replace what the table holds of them."""
    writer = df.hint("rebalance", "_load_date", "_batch_id").write.mode("overwrite").partitionBy("_load_date", "_batch_id")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table under its schema; an absent one reads as empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table unless there is one."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def read_batch(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Rows of one batch; on a table written by `write_batch` only its folder is read."""
    return df.filter(
        (F.col("_load_date") == F.lit(ctx.load_date).cast("date")) & (F.col("_batch_id") == ctx.batch_id)
    )


# --- keyed tables -------------------------------------------------------------------------------
#
# Rows lie in hash buckets that grow with the table: when its rows outgrow them, buckets are split in turn, and only
# those are written anew. What readers and the next writer must know is one small record: which folder
# holds the table, how many buckets it has, and which of them have their rows in the staging folder just now.

STATE = T.StructType(
    [T.StructField("seq", T.LongType()), T.StructField("version", T.IntegerType()), T.StructField("buckets", T.IntegerType()),
     T.StructField("rows", T.LongType()), T.StructField("staged", T.ArrayType(T.IntegerType()))]
)
#: Rows that a bucket holds in the mean before the table grows.
BUCKET_ROWS = 250_000


@dataclass(frozen=True)
class TableState:
    """`rows` counts what loads inserted; a load that was repeated after it broke off may be missing in it."""

    seq: int
    version: int
    buckets: int
    rows: int
    staged: list[int] | None = None


def table_state(spark: SparkSession, path: str) -> TableState | None:
    """The table's record; null if there is no table."""
    held = None
    for slot in (0, 1):
        row = read_table(spark, f"{path.rstrip('/')}__state/{slot}", STATE).first()
        if row is not None and (held is None or row["seq"] > held.seq):
            held = TableState(**row.asDict())
    return held


def _record(spark: SparkSession, path: str, state: TableState) -> TableState:
    """Make the record current. Records take turns in two places, so one of them is always whole."""
    state = replace(state, seq=state.seq + 1)
    row = spark.createDataFrame([(state.seq, state.version, state.buckets, state.rows, state.staged)], STATE)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}__state/{state.seq % 2}")
    return state


def _folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}__v{version}" if version else path


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Linear hashing: the hash by the next power of two, or by the one before where that bucket is not there yet."""
    power = 1 << (buckets - 1).bit_length()
    h = F.xxhash64(*keys)
    wide = F.pmod(h, F.lit(power))
    return F.when(wide < buckets, wide).otherwise(F.pmod(h, F.lit(max(power // 2, 1)))).cast("int")


def _write_buckets(df: DataFrame, folder: str, mode: str, overwrite: str = "dynamic") -> None:
    # The rebalance hint splits large buckets over tasks and packs small ones together.
    writer = df.hint("rebalance", BUCKET).write.mode(mode).partitionBy(BUCKET)
    writer.option("partitionOverwriteMode", overwrite).parquet(folder)


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])


def _staging(path: str) -> str:
    return f"{path.rstrip('/')}__staged"


def read_keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table kept by `upsert_table`, without its bucket column."""
    state = table_state(spark, path)
    rows = read_table(spark, _folder(path, state.version if state else 0), _with_bucket(schema))
    if state and state.staged is not None:
        staged = read_table(spark, _staging(path), _with_bucket(schema))
        rows = rows.filter(~F.col(BUCKET).isin(state.staged)).unionByName(staged)
    return rows.drop(BUCKET)


def _swap(spark: SparkSession, path: str, state: TableState, rows: DataFrame, buckets: list[int]) -> TableState:
    """Put `rows` in place of all rows of some buckets.

    They are staged first. From the moment the record names the buckets, their rows are the staged
    ones, for readers and for a writer that finds the swap unfinished.
    """
    _write_buckets(rows, _staging(path), "overwrite", "static")
    state = _record(spark, path, replace(state, staged=buckets))
    return _finish(spark, path, state, T.StructType([f for f in rows.schema if f.name != BUCKET]))


def _finish(spark: SparkSession, path: str, state: TableState, schema: T.StructType) -> TableState:
    """Move staged rows to their buckets; may be repeated."""
    if state.staged is None:
        return state
    folder, staged = _folder(path, state.version), read_table(spark, _staging(path), _with_bucket(schema))
    _write_buckets(staged, folder, "overwrite")
    filled = {row[0] for row in staged.select(BUCKET).distinct().collect()}  # numbers of buckets
    _delete(spark, [f"{folder}/{BUCKET}={b}" for b in state.staged if b not in filled])
    return _record(spark, path, replace(state, staged=None))


def upsert_table(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], buckets: int = 64, bucket_rows: int | None = None
) -> dict[str, int]:
    """Update matched rows and insert the others; `source` holds each key once. Gives out how many of each.

    The first load writes everything, into `buckets` buckets or as many as its rows need. Later loads look
    for their keys in the buckets where these belong, reading key columns alone, rewrite only the buckets that
    hold a match, append the rest and let the table grow. A load that broke off may be repeated.
    """
    bucket_rows = bucket_rows or BUCKET_ROWS
    state = table_state(spark, path)
    if state is None:
        rows = _first_load(spark, path, source, keys, buckets, bucket_rows)
        return {"inserted": rows, "updated": 0}
    source = materialize(source)
    state = _finish(spark, path, state, source.schema)
    folder, schema = _folder(path, state.version), _with_bucket(source.schema)
    placed = source.withColumn(BUCKET, bucket_of(keys, state.buckets))
    hit = [row[0] for row in placed.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
    held = read_table(spark, folder, schema).filter(F.col(BUCKET).isin(hit))
    known = materialize(rows_with_keys_of(held.select(*keys, BUCKET), source, keys))
    touched = {row[BUCKET]: row["count"] for row in known.groupBy(BUCKET).count().collect()}
    new = source.count() - sum(touched.values())  # a repeated load finds its own rows and inserts none
    _write_buckets(placed.join(known, keys, "left_anti"), folder, "append")
    state = _record(spark, path, replace(state, rows=state.rows + new))
    if touched:
        rows = read_table(spark, folder, schema).filter(F.col(BUCKET).isin(*touched))
        matched = placed.join(known.select(*keys), keys, "left_semi")
        state = _swap(spark, path, state, merge_upsert(rows, matched, keys), sorted(touched))
    grow_table(spark, path, source.schema, keys, bucket_rows, state)
    return {"inserted": new, "updated": sum(touched.values())}


def _first_load(spark: SparkSession, path: str, source: DataFrame, keys: list[str], buckets: int, bucket_rows: int) -> int:
    """Write all rows. If they prove too many for the buckets, they are laid out once more, as the next version."""
    _write_buckets(source.withColumn(BUCKET, bucket_of(keys, buckets)), path, "overwrite", "static")
    held, version = read_table(spark, path, _with_bucket(source.schema)), 0
    rows = held.count()  # from the files' footers
    if rows > buckets * bucket_rows:
        buckets, version = -(-rows // bucket_rows), 1
        _write_buckets(held.withColumn(BUCKET, bucket_of(keys, buckets)), _folder(path, version), "overwrite", "static")
    _record(spark, path, TableState(0, version, buckets, rows))
    return rows


def grow_table(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], bucket_rows: int | None = None, state: TableState | None = None
) -> None:
    """Split buckets in turn until they hold no more than `bucket_rows` rows in the mean; a round splits each once at most."""
    state = _finish(spark, path, state or table_state(spark, path), schema)
    target = -(-state.rows // (bucket_rows or BUCKET_ROWS))
    while state.buckets < target:
        grown = min(target, 1 << state.buckets.bit_length())
        split = _split_sources(state.buckets, grown)
        rows = read_table(spark, _folder(path, state.version), _with_bucket(schema)).filter(F.col(BUCKET).isin(split))
        moved = rows.withColumn(BUCKET, bucket_of(keys, grown))
        state = _swap(spark, path, replace(state, buckets=grown), moved, split)


def _split_sources(before: int, after: int) -> list[int]:
    """The buckets whose rows are placed anew when `before` buckets become `after`, the new ones included."""
    half = (1 << (after - 1).bit_length()) // 2
    new = range(before, after)
    return sorted({n - half for n in new} | set(new))


def replace_table(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], buckets: int = 64) -> None:
    """Put other rows, which may be derived from the table itself, in place of a keyed table.

    They are written to a folder of their own, and the table is that folder from the moment its record
    says so: whenever this stops, the table is the old one or the new one. The folder before is kept for readers
    that are under way; `expire_versions` removes those.
    """
    old = table_state(spark, path) or TableState(0, 0, buckets, 0)
    folder, schema = _folder(path, old.version + 1), rows.schema
    _write_buckets(rows.withColumn(BUCKET, bucket_of(keys, old.buckets)), folder, "overwrite", "static")
    held = read_table(spark, folder, _with_bucket(schema)).count()  # from the files' footers
    _record(spark, path, TableState(old.seq, old.version + 1, old.buckets, held))


def _delete(spark: SparkSession, folders: list[str]) -> list[str]:
    """Remove folders; those that were there are given out."""
    gone = []
    for folder in folders:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True):
            gone.append(folder)
    return gone


def expire_versions(spark: SparkSession, path: str) -> list[str]:
    """Remove the folders of all versions before the current one; they are given out."""
    state = table_state(spark, path)
    return _delete(spark, [_folder(path, version) for version in range(state.version if state else 0)])
