"""SimHash near-duplicates: an inverted index on byte positions with count filtering.

A fingerprint is eight bytes. Two of them that differ in at most two bits share at least six bytes in
place, and so at least four of any six positions that hold them.

1. Fingerprints. XXH64 of every shingle (repeats included); a bit is set if it is set in over half of
   them. Equal fingerprints are one entry from here on.
2. Index. Positions form four pairs; an entry is posted under the bytes of each two pairs, six lists in all.
   Linked entries meet in one list at least, as two differing bytes leave two pairs untouched. Lists
   longer than LIST are counted first and posted again under each two of the other four positions,
   where linked entries must agree as well; such a list holds at most 65,536 entries.
3. Tally. Within a list, shared bytes are counted per pair of entries; pairs with fewer than six are left, the others
   verified bit by bit. In the lists of six bytes the count is met by all, and instead of all
   pairs the 136 neighbours of each entry's other two bytes are looked up.
4. Classes. A task reports one edge per linked entry and list, never all pairs.

Null and empty texts and texts without words have fingerprint zero and link like any other. Rows that
repeat a key are rows of their own; a class takes the smallest key in it, null if it has none. Long
texts are read in pieces, so memory does not grow with them beyond the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import new_folder, shuffle_partitions, small, stored, texts
from vacancia.llm.components import components
from vacancia.llm.words import LOWER

WORDS, SEED = 3, 42
#: Bits that may differ, and the bytes in place that then agree.
BITS, SHARED = 2, 6
#: Entries of a four-byte list that are compared pair by pair; longer ones go to six-byte lists.
LIST = 256
#: Bytes of a text that are split into words at once; shingles whose bits are counted at once.
PIECE, COUNTED = 4 << 20, 1 << 16

PAIRS = [(0, 1), (2, 3), (4, 5), (6, 7)]
#: Positions of each list, by number: four, or six beginning with the four of the long list.
FOURS = [a + b for a, b in combinations(PAIRS, 2)]
SIXES = [four + more for four in FOURS for more in combinations([p for p in range(8) if p not in four], 2)]
_NEAR = np.array([0] + [1 << a | 1 << b for a in range(16) for b in range(a, 16)], np.int64)


def pieces(body: bytes) -> Iterator[bytes]:
    """The text cut at white space into pieces of about PIECE bytes."""
    at, blank = 0, re.compile(rb"[\x20\x09-\x0D]")
    while len(body) - at > PIECE:
        end = blank.search(body, at + PIECE)
        if not end:
            break
        yield body[at : end.start()]
        at = end.start()
    yield body[at:] if at else body


def simhash(body: bytes) -> int:
    """The fingerprint of one text as an unsigned number."""
    ones, n, held = np.zeros(64, np.int64), 0, []
    for piece in pieces(body):
        words = held + piece.translate(LOWER).split()
        if len(words) < WORDS:
            held = words
            continue
        for low in range(0, len(words) - WORDS + 1, COUNTED):
            part = words[low : low + COUNTED + WORDS - 1]
            hashes = _hashes(part, WORDS)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(hashes)
        held = words[1 - WORDS :]
    if not n and held:
        ones, n = np.unpackbits(_hashes(held, len(held)).view(np.uint8), bitorder="little").astype(np.int64), 1
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each `width` words in a row, joined by spaces."""
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1]).tolist()
    count, digest = len(words) - width + 1, xxhash.xxh64_intdigest
    return np.fromiter((digest(text[a:b], SEED) for a, b in zip(begins, ends[width - 1 :].tolist())), "<u8", count)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and entry (the fingerprint as a signed long) of every row."""

    def run(batches):
        for batch in batches:
            found = np.fromiter((simhash(b.as_py()) for b in batch.column("body")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "entry"])

    return texts(docs, key, text).mapInArrow(run, "doc_id long, entry long")


def _bytes_at(entry, positions):
    """The bytes of an entry at some positions, as one number; all else is zero."""
    mask = sum(0xFF << 8 * p for p in positions)
    return entry.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def _posted(entries: DataFrame, lists: list[tuple], first: int) -> DataFrame:
    """(list number, bytes, entry): each entry in each of `lists`, which are numbered from `first`."""
    keys = [F.struct(F.lit(first + i).alias("list"), _bytes_at(F.col("entry"), p).alias("bytes")) for i, p in enumerate(lists)]
    return entries.select("entry", F.explode(F.array(*keys)).alias("k")).select("k.list", "k.bytes", "entry")


def _index(entries: DataFrame) -> DataFrame:
    """The postings: lists of four bytes, and those of six in place of the long ones."""
    posted = _posted(entries, FOURS, 0)
    long = posted.groupBy("list", "bytes").count().filter(F.col("count") > LIST)
    long = small(stored(long.select(F.col("list").alias("long_list"), F.col("bytes").alias("long_bytes")), new_folder(entries.sparkSession, "long-lists")), 16)
    in_long = (F.col("list") == F.col("long_list")) & (F.col("bytes") == F.col("long_bytes"))
    sixes = [
        F.struct(F.lit(len(FOURS) + 6 * four + i).alias("list"), _bytes_at(F.col("entry"), SIXES[6 * four + i]).alias("bytes"), F.lit(four).alias("four"))
        for four in range(len(FOURS))
        for i in range(6)
    ]
    short = posted.join(long, in_long, "left_anti")
    again = posted.join(long, in_long, "left_semi").select("list", "entry", F.explode(F.array(*sixes)).alias("k"))
    again = again.filter("k.four = list").select("k.list", "k.bytes", "entry")
    return short.unionByName(again)


def labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that links (a, b) lead to, for each of n places."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def _within_short(group: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked places within lists of four bytes: shared bytes are tallied for every pair of a list."""
    raw = entry.view(np.uint8).reshape(-1, 8)
    a, b = [], []
    i = np.arange(len(entry))
    for step in range(1, len(entry)):
        i = i[i + step < len(entry)]
        i = i[group[i] == group[i + step]]
        if not len(i):
            break
        tally = (raw[i] == raw[i + step]).sum(1)
        met = i[tally >= SHARED]
        near = met[np.bitwise_count(entry[met] ^ entry[met + step]) <= BITS]
        a.append(near)
        b.append(near + step)
    return np.concatenate([*a, i[:0]]), np.concatenate([*b, i[:0]])


def _within_six(entry: np.ndarray, positions: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Linked places within one list of six bytes, by the neighbours of the other two bytes."""
    low, high = (p for p in range(8) if p not in positions)
    raw = entry.view(np.uint8).reshape(-1, 8)
    rest = raw[:, low].astype(np.int64) | raw[:, high].astype(np.int64) << 8
    place = np.full(1 << 16, -1, np.int64)
    place[rest] = np.arange(len(rest))
    a, b = [], []
    for mask in _NEAR[1:]:
        other = place[rest ^ mask]
        met = np.flatnonzero(other > np.arange(len(rest)))
        a.append(met)
        b.append(other[met])
    return np.concatenate(a), np.concatenate(b)


def _edges(group: np.ndarray, entry: np.ndarray, six: tuple | None) -> pa.RecordBatch:
    """One edge per linked entry: to the smallest place of what it is linked with here."""
    a, b = _within_six(entry, six) if six else _within_short(group, entry)
    root = labels(a, b, len(entry))
    at = np.flatnonzero(root != np.arange(len(entry)))
    return pa.RecordBatch.from_arrays([pa.array(entry[at].view(np.int64)), pa.array(entry[root[at]].view(np.int64))], ["a", "b"])


#: Postings that are compared at once.
AT_ONCE = 1 << 16


def _search(postings: DataFrame, partitions: int) -> DataFrame:
    """Edges (a, b) between linked entries."""
    fours = len(FOURS)

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3

        def ready(last: bool):
            """Whole lists of what is held; an unfinished one waits."""
            nonlocal held
            number, key, entry = held
            if not len(number):
                return
            new = np.append(True, (number[1:] != number[:-1]) | (key[1:] != key[:-1]))
            cut = len(number) if last else np.flatnonzero(new)[-1]
            number, key, entry, new = number[:cut], key[:cut], entry[:cut].view(np.uint64), new[:cut]
            held = [h[cut:] for h in held]
            short = number < fours
            if short.any():
                yield _edges(np.cumsum(new)[short], entry[short], None)
            for one in np.split(np.flatnonzero(~short), np.flatnonzero(new[~short])[1:]):
                if len(one) > 1:
                    yield _edges(None, entry[one], SIXES[number[one[0]] - fours])

        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("list", "bytes", "entry"))]
            if len(held[0]) >= AT_ONCE:
                yield from ready(False)
        yield from ready(True)

    rows = postings.select(F.col("list").cast("long").alias("list"), "bytes", "entry")
    return rows.repartition(partitions, "list", "bytes").sortWithinPartitions("list", "bytes", "entry").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    spark = docs.sparkSession
    folder = new_folder(spark, "simhash")
    rows = stored(fingerprints(docs, key, text), f"{folder}/rows")
    entries = stored(rows.groupBy("entry").agg(F.min("doc_id").alias("least")), f"{folder}/entries")
    edges = stored(_search(_index(entries.select("entry")), shuffle_partitions(spark)), f"{folder}/edges")
    classes = components(edges, f"{folder}/classes").withColumnRenamed("node", "entry")
    known = entries.join(classes, "entry", "left").withColumn("root", F.coalesce("root", "entry"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = stored(known.join(least, "root").select("entry", "component_id"), f"{folder}/known")
    digits = F.lower(F.lpad(F.hex("entry"), 16, "0")).alias("fingerprint")
    return rows.join(known, "entry").select("doc_id", digits, "component_id")
