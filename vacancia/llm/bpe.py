"""Byte-level BPE encoding and decoding with a public rank file.

A scan over code-point classes finds the pre-tokens, a cache holds the ids of each, and the byte
lengths of the ids give the offsets that decoding and span look-ups use. Null text is encoded as
empty text; rows that repeat a key are encoded each.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vacancia.llm.common import texts
from vacancia.llm.tokens import encode_texts, id_bytes, rank_cache


@functools.cache
def id_lengths(path: str) -> np.ndarray:
    table = id_bytes(path)
    out = np.zeros(max(table) + 1, np.int64)
    for i, b in table.items():
        out[i] = len(b)
    return out


def ids_of(bodies: list[bytes], path: str) -> Iterator[np.ndarray]:
    cache = rank_cache(path)
    kind = f"<u{cache.width}"
    for packed in encode_texts(cache, bodies):
        yield np.frombuffer(packed, kind)


def offsets_of(ids: np.ndarray, path: str) -> np.ndarray:
    """Byte offset at which each id's bytes begin in the text."""
    ends = np.cumsum(id_lengths(path)[ids])
    return np.concatenate([[0], ends[:-1]]) if len(ids) else ends


def bytes_of(ids: np.ndarray, path: str) -> bytes:
    return b"".join(map(id_bytes(path).__getitem__, ids.tolist()))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids and the byte offset of each id, for every row."""

    def run(batches):
        for batch in batches:
            out = list(ids_of(batch.column("body").to_pylist(), path))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x.astype(np.int32) for x in out], pa.list_(pa.int32())),
                    pa.array([offsets_of(x, path) for x in out], pa.list_(pa.int64())),
                ],
                ["doc_id", "ids", "offsets"],
            )

    return texts(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded bytes of each row of `encode`; null ids give empty bytes."""

    def run(batches):
        for batch in batches:
            rows = (bytes_of(np.array(x or [], np.int64), path) for x in batch.column("ids").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "body"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, body binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes decoded from them.

    Encodes and decodes in one pass, so that the ids of a corpus need not travel.
    """

    def run(batches):
        for batch in batches:
            counts, coded, decoded, last = [], [], [], []
            for ids in ids_of(batch.column("body").to_pylist(), path):
                counts.append(len(ids))
                coded.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(bytes_of(ids, path)).hexdigest())
                last.append(int(offsets_of(ids, path)[-1]) if len(ids) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string()), pa.array(last, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "last_offset"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, last_offset long"
    return texts(docs, key, text).mapInArrow(run, schema)
