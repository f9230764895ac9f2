"""SpotSigs fingerprints: chains of content words behind common-word anchors.

Wherever an anchor (a common word, or the start of the text) stands, the next content words form a
signature; chains are cut at the end of the text. The sorted set of signatures is the fingerprint,
written as text. Likeness is the Jaccard similarity of two sets: their lengths bound it, so under a
threshold sets of too different lengths are not intersected. Nothing here searches for pairs.

Texts without words have a fingerprint of their bytes; empty and null texts have the empty one, which
is like itself only. Rows that repeat a key follow each other in the order of their texts.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import shuffle_partitions, texts
from vacancia.llm.words import BASE, MARKS, groups, mix, word_hashes

# Common words of English, German, French and Spanish that serve as anchors.
ANCHORS = (
    "a an the is was are be to of in and that this for with by on as at it from or not "
    "der die das und ist ein eine zu den von mit im auf für sich nicht als auch dem des "
    "le la les de des et un une est que qui dans par pour sur au du en pas ou "
    "el los las y en es por para con una del se lo su como o"
).split()
#: Content words of a chain.
CHAIN = 3


def signature_sets(bodies: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct signatures of each text."""
    anchors = word_hashes([" ".join(ANCHORS).encode()], MARKS)[0]
    for group in groups(bodies):
        words, per_text = word_hashes(group, MARKS)
        begin = np.concatenate([[0], np.cumsum(per_text)])
        anchor = np.isin(words, anchors)
        content = np.append(words[~anchor], np.zeros(CHAIN, np.uint64))
        before = np.concatenate([[0], np.cumsum(~anchor)])  # content words before each word
        last = before[begin[1:]]  # of each text
        text_of = np.repeat(np.arange(len(group)), per_text)
        at = np.flatnonzero(anchor)
        full = np.flatnonzero(per_text)  # texts with words begin with an anchor of their own
        owner = np.concatenate([text_of[at], full])
        chain = mix(np.concatenate([words[at], np.zeros(len(full), np.uint64)]) + BASE)
        place = np.concatenate([before[at], before[begin[:-1][full]]])
        for j in range(CHAIN):
            there = place + j < last[owner]
            chain = mix((chain ^ np.where(there, content[np.minimum(place + j, len(content) - 1)], np.uint64(j + 1))) * BASE)
        short = (chain >> np.uint64(32)) | (owner.astype(np.uint64) << np.uint64(32))
        short = np.unique(short)
        cuts = np.searchsorted(short, np.arange(1, len(group), dtype=np.uint64) << np.uint64(32))
        for body, part in zip(group, np.split(short, cuts)):
            if not len(part) and body:
                part = np.array([xxhash.xxh32_intdigest(body)])
            yield part.astype(np.uint32)


def to_text(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.astype("<u4").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity, or 0 if it is below `least`; the set lengths are looked at first."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < least * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    share = common / (len(a) + len(b) - common)
    return share if share >= least else 0.0


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint and its number of signatures, for every row."""

    def run(batches):
        for batch in batches:
            sets = list(signature_sets(batch.column("body").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(to_text, sets), pa.string()), pa.array(map(len, sets), pa.int64())],
                ["doc_id", "fingerprint", "n_signatures"],
            )

    return texts(docs, key, text).mapInArrow(run, "doc_id long, fingerprint string, n_signatures long")


FIELDS = [
    ("doc_id", pa.int64(), "long"),
    ("n_chars", pa.int64(), "long"),
    ("edited_sha256", pa.string(), "string"),
    ("fingerprint", pa.string(), "string"),
    ("edited_fingerprint", pa.string(), "string"),
    ("near_edited", pa.float64(), "double"),
    ("near_next", pa.float64(), "double"),
]
SCHEMA = ", ".join(f"{name} {kind}" for name, _, kind in FIELDS)


def edit(text: str, following: str) -> str:
    """The last third of the code points gives way to as many from the start of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compare(keys: list, bodies: list[bytes], nexts: list[bytes]) -> list[tuple]:
    """A row of FIELDS for each text and the one that follows it."""
    whole = [b.decode() for b in bodies]
    edited = [edit(t, n.decode()).encode() for t, n in zip(whole, nexts)]
    own, new = list(signature_sets(bodies)), list(signature_sets(edited))
    after = [own[i + 1] if i + 1 < len(bodies) and nexts[i] is bodies[i + 1] else None for i in range(len(bodies))]
    missing = [i for i, x in enumerate(after) if x is None]
    for i, x in zip(missing, signature_sets([nexts[i] for i in missing])):
        after[i] = x
    return [
        (keys[i], len(whole[i]), hashlib.sha256(edited[i]).hexdigest(), to_text(own[i]), to_text(new[i]),
         likeness(own[i], new[i]), likeness(own[i], after[i]))
        for i in range(len(bodies))
    ]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(FIELDS)
    arrays = [pa.array(c, kind) for c, (_, kind, _) in zip(columns, FIELDS)]
    return pa.RecordBatch.from_arrays(arrays, [f[0] for f in FIELDS])


def _ranges(rows: DataFrame, parts: int) -> DataFrame:
    """Rows with the number of their key's range (0 lowest; keys that are null have their own)."""
    cuts = rows.select(F.col("doc_id").cast("double")).approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts)
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    keyed = rows.withColumn("point", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan"))))
    bucketer = Bucketizer(splits=splits if len(splits) > 2 else [-math.inf, 0.0, math.inf], inputCol="point", outputCol="range", handleInvalid="keep")
    ranged = bucketer.transform(keyed).drop("point")
    return ranged.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("range").cast("int")))


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """FIELDS for every row, against its edited text and the next text in descending key order.

    Ranges of keys follow from approximate quantiles. A range also receives the first text of the
    next one, so a task compares all its neighbours, and texts are shuffled once and stored nowhere.
    What the driver sees is one key per range.
    """
    spark = docs.sparkSession
    rows = texts(docs, key, text)
    parts = shuffle_partitions(spark)
    ranged = _ranges(rows, 4 * parts)
    tops = sorted(((r["range"], r["top"]) for r in ranged.groupBy("range").agg(F.max("doc_id").alias("top")).collect()), reverse=True)
    after = [(tops[i][0], *tops[(i + 1) % len(tops)]) for i in range(len(tops))]  # (range, next range, its first key)
    after = spark.createDataFrame(after, "target int, range_ int, top long")
    first = (F.col("range") == F.col("range_")) & F.col("doc_id").eqNullSafe(F.col("top"))
    heads = ranged.join(F.broadcast(after), first).groupBy("target").agg(F.min("body").alias("body"))
    heads = heads.select(F.col("target").alias("range"), F.lit(1).alias("follows"), F.lit(None).cast("long").alias("doc_id"), "body")
    laid = ranged.select("range", F.lit(0).alias("follows"), "doc_id", "body").unionByName(heads)
    down = F.col("doc_id").desc_nulls_last()
    laid = laid.repartition(parts, "range").sortWithinPartitions("range", "follows", down, "body")

    def walk(batches):
        held = None
        for batch in batches:
            ranges, ends = batch.column("range").to_pylist(), batch.column("follows").to_pylist()
            keys, bodies = batch.column("doc_id").to_pylist(), batch.column("body").to_pylist()
            if not keys:
                continue
            if held:
                ranges, ends, keys, bodies = ([h, *x] for h, x in zip(held, (ranges, ends, keys, bodies)))
            held = ranges[-1], ends[-1], keys[-1], bodies[-1]
            own = [i for i in range(len(keys) - 1) if not ends[i]]
            yield _batch(compare([keys[i] for i in own], [bodies[i] for i in own], [bodies[i + 1] for i in own]))

    return laid.mapInArrow(walk, SCHEMA)
