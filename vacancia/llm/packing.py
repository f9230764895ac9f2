"""Best-fit packing of token pieces into sequences of a fixed length, in bulk-synchronous steps.

Sizes are whole numbers up to the sequence length, so the sorted orders of pieces and of gaps are
known from a count per size and a rank within it. A step takes the pieces of one size, longest
first: their successors are the smallest gaps that hold them, equal claims are resolved by rank
(the k-th piece gets the k-th place), the gaps shrink, and the next step follows. The steps move
intervals of ranks, never pieces: the driver holds at most one counter per size and the intervals
that the steps cut, whatever the number of documents. Ranks are counted where the pieces lie and
shifted by the counts of earlier tasks, so no task sees all pieces of a size.

Ids are the library's at its default flags: a text that spells an added token holds that token's id.
Null text counts as empty: the document is its end id alone. Rows that repeat a key are packed each.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import new_folder, small, stored, texts
from vacancia.llm.tokens import encode_texts, library_cache

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


def cut(docs: DataFrame, tokenizer: str, end_id: int, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in the same task.

    A document longer than `size` is cut into pieces of `size`; its first piece holds what is over.
    """

    def run(batches):
        cache = library_cache(tokenizer, encode_special_tokens=False)
        end, kind = end_id.to_bytes(cache.width, "little"), f"<u{cache.width}"
        seen: dict[int, int] = defaultdict(int)
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            keys = batch.column("doc_id").to_pylist()
            for name, packed in zip(keys, encode_texts(cache, batch.column("body").to_pylist())):
                ids = np.frombuffer(packed + end, kind).astype("<u4")
                begin, piece = 0, 0
                stop = len(ids) % size or min(size, len(ids))
                while begin < len(ids):
                    length = stop - begin
                    rows.append((name, piece, begin, length, zlib.crc32(ids[begin:stop].tobytes()), part, seen[length]))
                    seen[length] += 1
                    begin, stop, piece = stop, stop + size, piece + 1
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
            )
        cache.clear()  # workers live on; what they keep counts against the stages that follow

    return texts(docs, key, text).mapInArrow(run, PIECE)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """The moves of all steps: (length, first rank, first sequence, pieces per sequence, offset).

    The pieces of a length from a move's first rank up to the next move's lie in successive
    sequences, so many in each. Sizes of pieces run down from the largest; a gap takes as many
    pieces of the size as it holds before the next larger gap is opened, as best fit does.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, sequences)
    order: list[int] = []  # the gaps there are, ascending
    moves, sequences = [], 0

    def put(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, count))

    def fill(length: int, rank: int, left: int, gap: int, first: int, count: int) -> tuple[int, int]:
        """Place up to `left` pieces; (pieces placed, sequences used)."""
        each = gap // length
        full = min(count, left // each)
        placed = full * each
        if full:
            moves.append((length, rank, first, each, size - gap))
            put(gap - each * length, first, full)
        if full < count and placed < left:
            moves.append((length, rank + placed, first + full, each, size - gap))
            put(gap - (left - placed) * length, first + full, 1)
            return left, full + 1
        return placed, full

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (at := bisect_left(order, length)) < len(order):
            gap = order[at]
            waiting = gaps.pop(gap)
            del order[at]
            while waiting and left:
                first, count = waiting.pop()
                placed, used = fill(length, rank, left, gap, first, count)
                rank, left = rank + placed, left - placed
                if used < count:
                    waiting.append((first + used, count - used))
            for first, count in waiting:
                put(gap, first, count)
        if left:
            each = size // length
            count = -(-left // each)
            fill(length, rank, left, size, sequences, count)
            sequences += count
    return moves


def place(pieces: DataFrame, size: int) -> DataFrame:
    """Pieces with sequence_id and offset. `pieces` must be stored: ranks hold for one reading."""
    spark = pieces.sparkSession
    counted = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), new_folder(spark, "piece-counts"))
    totals = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # up to `size` rows
    moves = sorted(best_fit(totals, size))
    table = np.array(moves, np.int64).reshape(-1, 5)
    keys = table[:, 0] << 44 | table[:, 1]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    shift = stored(shift, new_folder(spark, "piece-shifts"))
    ranked = pieces.join(small(shift, 32), ["part", "length"])
    shared = spark.sparkContext.broadcast((table, keys))

    def run(batches):
        moves, keys = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, "right") - 1
            _, first, sequence, each, offset = moves[at].T
            turn = rank - first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence + turn // each), pa.array(offset + turn % each * length)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    out = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("shift")).alias("rank"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return out.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document with its place: sequence_id and offset, gapless from 0."""
    pieces = stored(cut(docs, tokenizer, end_id, size, key, text), new_folder(docs.sparkSession, "pieces"))
    return place(pieces, size)
