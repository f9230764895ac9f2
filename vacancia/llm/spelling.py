"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

1. Words. Runs of letters are counted per task before they are shuffled, so a frequent word is no hot key.
2. Lists. An edit falls into the front or the back half of a word, so two words one edit apart share the
   other half: a word is listed under its front and its back half, for its own length and for the next
   shorter one. Lists longer than BLOCK words are cut into blocks, and each pair of blocks is a piece of
   work of its own.
3. Tiles. The words of a tile form two matrices of code points, padded behind and padded in front. All
   pairs of a tile are compared column by column: the common prefix from the one, the common suffix from the
   other. Two words are one edit apart if the two together reach the longer length minus one. A pair that
   shares both halves counts in the front list alone. Tasks report a word's number of near words and the
   best of them, never pairs.
4. Roots. A form has at least twice the occurrences of its word, so chains are short; they are followed by
   doubling, each word pointing to its form's form.

Null and empty texts hold no words. Rows that repeat count as often as they stand; a row without a key has
the empty text as its key. Ties between forms go to the smallest word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import new_folder, shuffle_partitions, small, stored, texts
from vacancia.llm.words import LOWER

RUN = re.compile("[a-zÀ-ÿ]+")
#: One in so many (document, run) pairs loses a code point.
EVERY = 97
LEAST_CHARS, LEAST_TIMES = 5, 3
#: A form has at least so many times the occurrences of its word.
TIMES = 2
#: Words of a block of a long list; rows of a tile; longer words are compared one by one.
BLOCK, TILE, WIDE = 1024, 256, 512
#: Texts of more code points are read run by run; distinct words a task holds before it passes them on.
LONG_TEXT, HELD_WORDS = 1 << 20, 200_000

FRONT, BACK = 0, 1


def altered(key, run: str) -> str:
    """The run, without one code point if its checksum says so."""
    h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n (its occurrences overall), of words that are long and frequent enough."""

    def run(batches):
        held: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
                whole = body.as_py().translate(LOWER).decode()
                runs = RUN.findall(whole) if len(whole) < LONG_TEXT else (m.group() for m in RUN.finditer(whole))
                for word, n in Counter(runs).items():
                    word = altered(doc, word)
                    if len(word) >= LEAST_CHARS:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield rows()
        yield rows()

    counted = texts(docs, key, text).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TIMES)


def _lists(found: DataFrame) -> DataFrame:
    """(list, half, length, low, high, block, word, n): the lists of every word, in pairs of blocks.

    `length` is that of the shorter words of the list, `list` a hash of its half; equal hashes of other
    halves only add comparisons.
    """
    keys = []
    chars = F.char_length("word")
    for less in (0, 1):
        length = chars - less
        front = F.floor(length / 2).cast("int")
        halves = {FRONT: F.substring("word", F.lit(1), front), BACK: F.substring("word", -(length - front), length - front)}
        for half, part in halves.items():
            keys.append(F.struct(length.alias("length"), F.lit(half).alias("half"), F.xxhash64(length, F.lit(half), part).alias("list")))
    rows = found.select("word", "n", F.explode(F.array(*keys)).alias("k")).select("word", "n", "k.*")
    sizes = rows.groupBy("list").count().filter("count > 1")
    sizes = sizes.select("list", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    sizes = small(stored(sizes, new_folder(found.sparkSession, "word-lists")), 16)
    rows = rows.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("list", "half", "length", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "word", "n")


def code_points(held: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points, padded behind and padded in front to `width` columns."""
    behind = np.array(held, f"U{width}").view(np.uint32).reshape(len(held), width)
    in_front = np.array([w.rjust(width, "\0") for w in held], f"U{width}").view(np.uint32).reshape(len(held), width)
    return behind, in_front


def _leading(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal leading columns of every row of `a` with every row of `b`."""
    going = np.ones((len(a), len(b)), bool)
    count = np.zeros((len(a), len(b)), np.int32)
    for x, y in zip(a.T, b.T):
        going &= x[:, None] == y[None, :]
        if not going.any():
            break
        count += going
    return count


def _common(a: str, b: str) -> int:
    """Common leading code points of two long words."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def overlaps(held: list[str], lengths: np.ndarray, rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix, common suffix) of every word of `rows` with every word of `columns`.

    Both are at most the shorter length, as padding equals no letter and equal words do not occur.
    """
    a, b = held[rows], held[columns]
    width = int(max(lengths[rows].max(), lengths[columns].max()))
    if width > WIDE:
        pre = [[_common(x, y) for y in b] for x in a]
        suf = [[_common(x[::-1], y[::-1]) for y in b] for x in a]
        return np.array(pre), np.array(suf)
    (a_behind, a_front), (b_behind, b_front) = code_points(a, width), code_points(b, width)
    return _leading(a_behind, b_behind), _leading(a_front[:, ::-1], b_front[:, ::-1])


class _Best:
    """Number of near words and the best of them, of each word of some lists."""

    def __init__(self, held: list[str], n: np.ndarray):
        self.held, self.n = held, n
        self.near = np.zeros(len(held), np.int64)
        order = sorted(range(len(held)), key=lambda i: (-int(n[i]), held[i]))
        self.place = np.empty(len(held), np.int64)  # the smaller, the better
        self.place[order] = np.arange(len(held))
        self.order = np.array(order)
        self.best = np.full(len(held), len(held), np.int64)

    def add(self, i: np.ndarray, j: np.ndarray):
        for a, b in ((i, j), (j, i)):
            np.add.at(self.near, a, 1)
            np.minimum.at(self.best, a, self.place[b])

    def rows(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.near)
        form = self.order[self.best[at]]
        columns = [pa.array([self.held[i] for i in at], pa.string()), pa.array(self.near[at]), pa.array([self.held[i] for i in form], pa.string()), pa.array(self.n[form])]
        return pa.RecordBatch.from_arrays(columns, ["word", "near", "form", "form_n"])


def compare(held: list[str], n: np.ndarray, group: np.ndarray, block: np.ndarray, half: np.ndarray, length: np.ndarray, apart: np.ndarray) -> pa.RecordBatch:
    """The near words among rows of the same group; groups are in order.

    Where `apart`, a group holds two blocks, and only words of different ones are compared.
    """
    best = _Best(held, n)
    lengths = np.fromiter(map(len, held), np.int64, len(held))
    for top in range(0, len(held), TILE):
        for left in range(top, len(held), TILE):
            rows, columns = slice(top, top + TILE), slice(left, left + TILE)
            if group[rows][-1] < group[left]:
                break
            pre, suf = overlaps(held, lengths, rows, columns)
            longer = np.maximum(lengths[rows][:, None], lengths[columns][None, :])
            met = (pre + suf >= longer - 1) & (group[rows][:, None] == group[columns][None, :])
            met &= np.minimum(lengths[rows][:, None], lengths[columns][None, :]) == length[rows][:, None]
            met &= (half[rows][:, None] == FRONT) | (pre < length[rows][:, None] // 2)
            met &= ~apart[rows][:, None] | (block[rows][:, None] != block[columns][None, :])
            met &= np.arange(top, top + met.shape[0])[:, None] < np.arange(left, left + met.shape[1])[None, :]
            i, j = np.nonzero(met)
            best.add(i + top, j + left)
    return best.rows()


def near_words(found: DataFrame) -> DataFrame:
    """word, n_near, form and form_n of words (word, n) with near words; the form is the best of those."""
    group_of = ["length", "half", "list", "low", "high"]

    def run(batches):
        held = None
        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in [*group_of, "block", "word", "n"]}
            held = {c: np.concatenate([held[c], x]) for c, x in columns.items()} if held else columns
            new = np.append(True, np.any([held[c][1:] != held[c][:-1] for c in group_of], axis=0))
            cut = np.flatnonzero(new)[-1] if len(held["n"]) else 0
            if cut >= TILE:
                yield work({c: x[:cut] for c, x in held.items()}, np.cumsum(new[:cut]))
                held = {c: x[cut:] for c, x in held.items()}
        if held and len(held["n"]):
            new = np.append(True, np.any([held[c][1:] != held[c][:-1] for c in group_of], axis=0))
            yield work(held, np.cumsum(new))

    def work(rows: dict, group: np.ndarray) -> pa.RecordBatch:
        apart = rows["low"] != rows["high"]
        return compare(rows["word"].tolist(), rows["n"], group, rows["block"], rows["half"], rows["length"], apart)

    lists = _lists(found)
    lists = lists.repartition(shuffle_partitions(found.sparkSession), "list", "low", "high").sortWithinPartitions(*group_of, "word")
    parts = lists.mapInArrow(run, "word string, near long, form string, form_n long")
    rank = F.struct((-F.col("form_n")).alias("rank"), "form")
    best = parts.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(rank).alias("best"))
    return best.select("word", "n_near", "best.form", (-F.col("best.rank")).alias("form_n"))


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) of the words in `forms` (word, form): where following forms ends."""
    now, turn = stored(forms.select("word", F.col("form").alias("root")), f"{folder}/0"), 0
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        turn += 1
        both = now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        both = stored(both, f"{folder}/{turn}")
        now = both.select("word", "root")
        if both.filter("moved").isEmpty():
            return now


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    folder = new_folder(docs.sparkSession, "spelling")
    found = stored(words(docs, key, text), f"{folder}/words")
    near = near_words(found)
    joined = found.join(near, "word", "left")
    has = F.col("form_n") >= TIMES * F.col("n")
    joined = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n")
    )
    joined = stored(joined, f"{folder}/forms")
    ends = roots(joined.filter("form IS NOT NULL"), f"{folder}/roots")
    return joined.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
