"""Token-id files: one zstandard frame per document, all with one shared dictionary.

A file holds the documents of one range of ids in ascending order:

    "IDSZ" | sha256 of the dictionary | frames | index | index offset, documents, id width | "IDSZ"

The index has key, whether the key is known, frame offset, frame length and id count per document,
so a short document is read with three small reads. The dictionary lies beside the files in
`dictionary`, whose digest every file repeats. A manifest table names the files that count: a task
that is run twice leaves a second file, but only one manifest row.

Ids are the library's at its default flags: a text that spells an added token holds that token's id.
Null text is empty text and still gets the end id. Rows without key come last; rows that repeat a
key follow each other.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancia.llm.common import new_folder, shuffle_partitions, stored, texts
from vacancia.llm.tokens import encode_texts, library_cache

MAGIC = b"IDSZ"
INDEX = np.dtype([("key", "<i8"), ("known", "u1"), ("offset", "<u8"), ("length", "<u8"), ("ids", "<u8")])
TAIL, TAIL_BYTES = "<QQQ4s", 28
#: The dictionary is trained on so many documents (those of smallest key hash), on so many ids of each.
SAMPLE_DOCUMENTS, SAMPLE_IDS, DICTIONARY_BYTES = 500, 8192, 64 << 10


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def train(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> bytes:
    """A dictionary from a bounded sample of id arrays; too small a sample serves as it is."""

    def run(batches):
        cache = library_cache(tokenizer, encode_special_tokens=False)
        for batch in batches:
            rows = [b[: SAMPLE_IDS * cache.width] for b in encode_texts(cache, batch.column("body").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    sample = texts(docs, key, text).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("body")).limit(SAMPLE_DOCUMENTS)
    samples = [bytes(r.ids) for r in sample.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def load_dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def write(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files of a corpus; returns the stored manifest: part, path, documents, ids."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    dictionary = train(docs, tokenizer, key, text)
    files, base = open_folder(folder)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/dictionary") as out:
        out.write(dictionary)
    digest = hashlib.sha256(dictionary).digest()

    def run(batches):
        cache = library_cache(tokenizer, encode_special_tokens=False)
        target = open_folder(folder)
        end = end_id.to_bytes(cache.width, "little")
        shared = load_dictionary(dictionary)
        pack = zstandard.ZstdCompressor(level=1, dict_data=shared) if shared else zstandard.ZstdCompressor(level=1)
        out, path, index, at, total = None, "", [], 0, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for name, ids in zip(keys, encode_texts(cache, batch.column("body").to_pylist())):
                if out is None:
                    path = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
                    out = target[0].open_output_stream(f"{target[1]}/{path}", buffer_size=1 << 20)
                    out.write(MAGIC + digest)
                    at = len(MAGIC) + len(digest)
                frame = pack.compress(ids + end)
                count = len(ids) // cache.width + 1
                out.write(frame)
                index.append((name or 0, name is not None, at, len(frame), count))
                at += len(frame)
                total += count
        if out is not None:
            out.write(np.array(index, INDEX).tobytes() + struct.pack(TAIL, at, len(index), cache.width, MAGIC))
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": f"{folder}/{path}", "documents": len(index), "ids": total}])

    # The text's hash splits the rows of a key that is null or repeated over several ranges.
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("body")]
    ordered = texts(docs, key, text).repartitionByRange(shuffle_partitions(spark), *order)
    ordered = ordered.sortWithinPartitions(*order, "body")
    return stored(ordered.mapInArrow(run, "part long, path string, documents long, ids long"), f"{folder}/manifest")


class TokenFile:
    """Reads one file; the dictionary's digest must be the one the file was written with."""

    def __init__(self, path: str):
        self.files, self.path = open_folder(path)
        folder = self.path.rsplit("/", 1)[0]
        with self.files.open_input_stream(f"{folder}/dictionary") as source:
            dictionary = source.read()
        self.source = self.files.open_input_file(self.path)
        size = self.source.size()
        start, count, self.width, magic = struct.unpack(TAIL, self.source.read_at(TAIL_BYTES, size - TAIL_BYTES))
        head = self.source.read_at(len(MAGIC) + 32, 0)
        if magic != MAGIC or head != MAGIC + hashlib.sha256(dictionary).digest():
            raise ValueError(f"not a token file of this dictionary: {path}")
        self.index = np.frombuffer(self.source.read_at(count * INDEX.itemsize, start), INDEX)
        shared = load_dictionary(dictionary)
        self.unpack = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()

    def ids(self, place: int) -> np.ndarray:
        row = self.index[place]
        frame = self.source.read_at(int(row["length"]), int(row["offset"]))
        return np.frombuffer(self.unpack.decompress(frame), f"<u{self.width}")

    def find(self, key: int) -> np.ndarray | None:
        """The ids of the first document of a key, by the sorted index alone."""
        keys = self.index["key"][: int(self.index["known"].sum())]
        place = int(np.searchsorted(keys, key))
        return self.ids(place) if place < len(keys) and keys[place] == key else None

    def all(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for place, row in enumerate(self.index):
            yield (int(row["key"]) if row["known"] else None), self.ids(place)


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens and crc32 of the ids, from the files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.select("part", "path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows, start = [], row["base"]
                for key, ids in TokenFile(row["path"]).all():
                    rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    spread = placed.repartition(shuffle_partitions(spark), "part")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
