"""A content-addressed archive in WARC files: payloads once, exact record headers apart.

Each distinct payload is stored once, in the response record of a `.warc.gz` file, a gzip member of its
own. `payloads` lists under the SHA-256 where that member stands, `headers` holds every record's header
text and the digest. Reading joins the two, reads the members and checks the digest. A digest counts
as verified if all payloads under it also agree in length and MD5; else the write fails. Equal payloads
are combined on the map side before they are shuffled, once; no later step shuffles a payload.

The other records follow in files of their own, so that the files together are the whole crawl: revisits
without payload, and short responses. The block of a response is a short HTTP head, as the pages carry
none of their own, and the payload; that of a revisit is the head alone. Files are closed at
`FILE_BYTES`. A task that is run again writes files under other names, and only those of the attempt
that ended are listed (`payloads`, `others`).

Of records with equal payloads of at least `REVISIT_BYTES`, the one with the smallest key is the
response and the others revisit it; shorter payloads are responses all. Null html is an empty
payload. Rows that repeat key and payload are the same record and have the same type; a row without
key revisits a known one, and is a response if there is none. Line ends in a URL are escaped; a page
without URL has its record's name for one. A record without a date bears that of the writing.
"""

from __future__ import annotations

import gzip
import uuid
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm.common import arrow_batches, new_folder, stored
from vacancia.llm.token_files import open_folder

REVISIT_BYTES = 100
FILE_BYTES = 1 << 30
LEVEL = 6
#: Records of an Arrow batch: bounds what a Python worker holds of long pages.
BATCH_RECORDS = 200
END = "\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}{END}"


def _escaped(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")


def _name(key: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(key.cast("string"), F.lit("unknown")))


def _header(revisit: Column, owner: Column) -> Column:
    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(END))

    def named(key: Column) -> Column:
        return F.concat(F.lit("<"), _name(key), F.lit(">"))

    url = F.when(F.length("url") > 0, _escaped(F.col("url"))).otherwise(_name(F.col("page_id")))
    return F.concat(
        F.lit(f"{VERSION}{END}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", named(F.col("page_id"))),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", named(owner)), line("WARC-Profile", PROFILE))).otherwise(""),
        line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", (F.when(revisit, 0).otherwise(F.col("bytes")) + len(HTTP_HEAD)).cast("string")),
        F.lit(END),
    )


def write_archive(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    body: str = "html",
    date: str | None = None,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Write the archive of a crawl; returns its folder. `date` names a column with the time of capture."""
    spark = pages.sparkSession
    folder = new_folder(spark, "archive")
    written = F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    captured = F.date_format(F.col(date), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date else written
    records = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(captured, written).alias("date"),
        F.coalesce(F.col(body), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    proof = F.concat_ws(" ", "bytes", F.md5("payload"))
    about = F.struct("page_id", "url", "date")
    stored_once = records.groupBy("digest").agg(
        F.first("payload").alias("payload"),
        F.coalesce(F.min(F.when(F.col("page_id").isNotNull(), about)), F.min(about)).alias("first"),
        F.min(proof).alias("low"),
        F.max(proof).alias("high"),
    )
    agreed = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payloads differ under digest "), F.col("digest"))).cast("binary")
    )
    owned = stored_once.select("digest", agreed.alias("payload"), "first.*").withColumn("bytes", F.octet_length("payload"))
    whole = _record(_header(F.lit(False), F.col("page_id")), F.col("payload"))
    places = write_members(owned.select("page_id", "digest", whole.alias("record")), folder, "payloads", file_bytes)

    owners = places.select("digest", F.col("page_id").alias("owner"))
    short = F.when(F.col("bytes") < REVISIT_BYTES, F.col("payload")).alias("short")
    heads = records.select("page_id", "url", "date", "digest", "bytes", short).join(owners, "digest")
    same = F.col("page_id").eqNullSafe(F.col("owner"))
    revisit = (F.col("bytes") >= REVISIT_BYTES) & F.col("owner").isNotNull() & ~same
    heads = heads.select("page_id", "digest", _header(revisit, F.col("owner")).alias("header"), "short", (~same).alias("other"))
    heads.write.option("compression", "zstd").parquet(f"{folder}/headers")
    others = spark.read.parquet(f"{folder}/headers").filter("other")
    others = others.select("page_id", "digest", _record(F.col("header"), F.coalesce("short", F.lit(b""))).alias("record"))
    write_members(others, folder, "others", file_bytes)
    return folder


def _record(header: Column, payload: Column) -> Column:
    """A record as it stands in a file; a revisit has no payload."""
    return F.concat(header.cast("binary"), F.lit(HTTP_HEAD).cast("binary"), payload, F.lit(END + END).cast("binary"))


INDEX = pa.schema(
    [("page_id", pa.int64()), ("digest", pa.string()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)
INDEX_SCHEMA = "page_id long, digest string, path string, offset long, length long"
RECORD = pa.schema([("page_id", pa.int64()), ("header", pa.string()), ("payload", pa.binary())])


def write_members(records: DataFrame, folder: str, name: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write records (page_id, digest, record) as `.warc.gz` files; returns the stored list of where each stands."""
    target = f"{folder}/{name}-files"
    files, base = open_folder(target)
    files.create_dir(base, recursive=True)

    def run(batches):
        store, path, out, at = open_folder(target), "", None, 0
        for batch in batches:
            rows = []
            for key, digest, record in zip(*(batch.column(c).to_pylist() for c in ("page_id", "digest", "record"))):
                if out is None:
                    path, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store[0].open_output_stream(f"{store[1]}/{path}", compression=None, buffer_size=1 << 20)
                member = gzip.compress(record, LEVEL, mtime=0)
                out.write(member)
                rows.append((key, digest, f"{target}/{path}", at, len(member)))
                at += len(member)
                if at >= file_bytes:
                    out.close()
                    out = None
            yield _batch(rows, INDEX)
        if out is not None:
            out.close()

    with arrow_batches(records.sparkSession, BATCH_RECORDS):
        return stored(records.mapInArrow(run, INDEX_SCHEMA), f"{folder}/{name}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _parts(record: bytes) -> tuple[str, bytes]:
    """Header and payload of a record; one whose lengths do not fit is damaged."""
    end = record.index(b"\r\n\r\n") + 4
    header = record[:end].decode()
    size = int(header.rpartition("Content-Length: ")[2])
    block = record[end : end + size]
    if record[end + size :] != b"\r\n\r\n" or not block.startswith(HTTP_HEAD.encode()):
        raise ValueError(f"damaged record: {header}")
    return header, block[len(HTTP_HEAD) :]


class _Reader:
    """Reads members of one file after the other; the last member is kept."""

    def __init__(self):
        self.path, self.file, self.place, self.parts = None, None, None, None

    def read(self, path: str, offset: int, length: int) -> tuple[str, bytes]:
        if path != self.path:
            if self.file:
                self.file.close()
            parent, name = path.rsplit("/", 1)
            files, base = open_folder(parent)
            self.path, self.file = path, files.open_input_file(f"{base}/{name}")
        if (path, offset) != self.place:
            self.parts = _parts(gzip.decompress(self.file.read_at(length, offset)))
            self.place = (path, offset)
        return self.parts


#: What one task reads, by compressed bytes, and the payloads of one batch.
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 16 << 20


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, header and payload of every record; a payload that fails its digest stops the job.

    Headers meet the places of their payloads by digest; each task then reads the members of a range of
    places. Ranges end in the record's key and header, so the records of one hot payload are read by many.
    """
    heads = spark.read.parquet(f"{folder}/headers").select("page_id", "header", "digest")
    places = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/payloads").drop("page_id")
    rows = heads.join(places, "digest")
    total = rows.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, total // SPLIT_BYTES + 1)
    order = ["path", "offset", "page_id", "header"]
    rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def run(batches):
        reader = _Reader()
        for batch in batches:
            found, size = [], 0
            for row in batch.to_pylist():
                payload = reader.read(row["path"], row["offset"], row["length"])[1]
                found.append((row["page_id"], row["header"], payload))
                size += len(payload)
                if size >= BATCH_BYTES:
                    yield _batch(found, RECORD)
                    found, size = [], 0
            yield _batch(found, RECORD)

    records = rows.mapInArrow(run, "page_id long, header string, payload binary")
    digest = _field("WARC-Payload-Digest", r"sha256:(\w+)")
    sound = F.when(F.sha2("payload", 256) == digest, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), digest)).cast("binary")
    )
    return records.select("page_id", "header", sound.alias("payload"))


def _field(name: str, pattern: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: {pattern}\r\n", 1)


def describe(records: DataFrame) -> DataFrame:
    """What the headers and payloads that were read say of each record."""
    refers = _field("WARC-Refers-To", r"<urn:page:(-?\d+)>")
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        _field("WARC-Type", r"(\w+)").alias("record_type"),
        F.when(refers != "", refers).cast("long").alias("refers_to"),
    )
