"""Similarity join of documents on word 5-grams: prefix filter, then a trie of ordered sets.

1. Screen. Each document's set is hashed; the n-grams of smallest hash (its prefix) go to buckets.
   Linked documents must share several of them, so a document whose prefix is hardly shared is done.
   A task tells an n-gram at most once per batch and marks it if its own batch shares it already:
   what a bucket receives of a common n-gram grows with the batches, not with the documents.
2. Order. The n-grams of the remaining sets are counted the same way and put in one global order,
   rarest first. Two linked sets share an n-gram of their first quarter; its smallest set is the hub
   where they meet.
3. Search. The sets of a hub are cut into blocks; each pair of blocks is a task that walks a trie of
   one block with all sets of the other (see `trie`). A pair is counted at its smallest common hub.
4. Classes. Tasks report links per set and one edge per set to a neighbour class, never all pairs.
   Equal sets were one set from the start; their copies count by number.

Nothing is capped: hubs, blocks and buckets hold whatever comes. Sets are told apart by 64-bit hash and
size, n-grams by 64-bit hash.

Null text, empty text and text without words have no n-grams and link with nothing. Rows that repeat
a key are rows of their own; a class takes the smallest key in it, null if it has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import new_folder, shuffle_partitions, small, stored, texts
from vacancia.llm.components import components
from vacancia.llm.trie import NEEDED, overlaps
from vacancia.llm.words import BASE, SPACES, groups, mix, word_hashes

WORDS = 5
#: Text characters per bucket of the screen; n-grams per bucket of the count: bound a task's memory.
BUCKET_CHARS, BUCKET_GRAMS = 24 << 20, 2 << 20
#: Sets are kept together in chunks of at least so many n-grams.
CHUNK_GRAMS = 400_000
#: A block of a hub holds so many sets, or so many n-grams.
BLOCK_SETS, BLOCK_GRAMS = 256, 200_000
#: n-grams are told in the screen by so many bytes of their hash; equal beginnings only add work.
TOLD_BYTES = 6


def gram_sets(bodies: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; a text of fewer words is one n-gram."""
    for group in groups(bodies):
        words, per_text = word_hashes(group, SPACES)
        n = len(words)
        padded = np.append(words, np.zeros(WORDS, np.uint64))
        grams = np.zeros(n, np.uint64)
        begin = np.concatenate([[0], np.cumsum(per_text)])
        ends = np.repeat(begin[1:], per_text)
        at = np.arange(n)
        for j in range(WORDS):
            grams = (grams ^ np.where(at + j < ends, padded[j : j + n], np.uint64(0))) * BASE
            grams ^= grams >> np.uint64(31)
        grams = mix(grams)
        for i, count in enumerate(per_text):
            yield np.unique(grams[begin[i] : begin[i] + max(min(count, 1), count - WORDS + 1)])


def needed(n):
    """The least n-grams that a set of n shares with a set it is linked with."""
    return -(-NEEDED * n // 100)


def voices(n):
    """The n-grams that linked prefixes share at least, for the smaller set of size n."""
    return np.maximum(1, n // 10)


def set_name(grams: np.ndarray) -> int:
    return np.frombuffer(xxhash.xxh3_64_digest(grams.tobytes()), ">i8")[0].item()


ENTRY = "bucket int, kind int, names binary, counts binary, grams binary"
ENTRY_NAMES = ["bucket", "kind", "names", "counts", "grams"]
TELL, DOCUMENT, HITS = range(3)


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ENTRY_NAMES)


def _screen(docs: DataFrame, buckets: int) -> DataFrame:
    """(kind, doc_id, known, name, n): a DOCUMENT row for every row, HITS rows with prefix n-grams shared."""
    width = TOLD_BYTES

    def tell(batches):
        part, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = batch.column("doc_id")
            sets = list(gram_sets(batch.column("body").to_pylist()))
            sizes = np.array([len(s) for s in sets], np.int64)
            names = np.array([set_name(s) for s in sets], np.int64)
            rows = []
            known = np.array(keys.is_valid().to_pylist(), np.int64)
            packed = np.stack([keys.fill_null(0).to_numpy(), known, names, sizes]).astype("<i8")
            turn += 1
            rows.append(((part * 31 + turn) % buckets, DOCUMENT, packed.tobytes(), None, None))
            _, first = np.unique(names, return_index=True)
            first = first[sizes[first] > 0]
            prefix = [sets[i][: sizes[i] - needed(sizes[i]) + voices(sizes[i])] for i in first]
            if prefix:
                owner = np.repeat(np.arange(len(first)), [len(p) for p in prefix])
                grams = np.concatenate(prefix)
                order = np.argsort(grams, kind="stable")
                grams, owner = grams[order], owner[order]
                new = np.append(True, grams[1:] != grams[:-1])
                group = np.cumsum(new) - 1
                times = np.bincount(group)
                hits = np.bincount(owner[times[group] > 1], minlength=len(first))
                met = np.flatnonzero(hits)
                if len(met):
                    packed = np.stack([names[first][met], hits[met]]).astype("<i8")
                    rows.append(((part * 17 + turn) % buckets, HITS, packed.tobytes(), None, None))
                grams, owner, shared = grams[new], owner[new], times > 1
                bucket = (grams >> np.uint64(20)) % np.uint64(buckets)
                order = np.lexsort((owner, ~shared, bucket))
                grams, owner, shared, bucket = grams[order], owner[order], shared[order], bucket[order]
                raw = grams.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width]
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(cuts)):
                    low, high = cuts[b], cuts[b + 1]
                    middle = low + int(shared[low:high].sum())  # marked ones first, without a name
                    who, count = np.unique(owner[middle:high], return_counts=True)
                    rows.append(
                        (int(b), TELL, names[first][who].astype("<i8").tobytes(),
                         np.append(middle - low, count).astype("<u4").tobytes(), raw[low:high].tobytes())
                    )
            yield _entries(rows)

    def weigh(key, table):
        out: list[np.ndarray] = []
        told, who, marked = [], [], []
        for kind, names, counts, grams in zip(*(table.column(c).to_pylist() for c in ENTRY_NAMES[1:])):
            if kind != TELL:
                block = np.frombuffer(names, "<i8").reshape(4 if kind == DOCUMENT else 2, -1)
                if kind == HITS:
                    block = np.stack([np.zeros_like(block[0]), np.zeros_like(block[0]), block[0], block[1]])
                out.append(np.vstack([np.full(block.shape[1], kind), block]))
                continue
            raw = np.frombuffer(grams, np.uint8).reshape(-1, width)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :width] = raw
            count = np.frombuffer(counts, "<u4")
            told.append(wide.view(">u8").ravel().astype(np.uint64))
            marked.append(np.arange(len(raw)) < count[0])
            who.append(np.concatenate([np.zeros(count[0], np.int64), np.repeat(np.frombuffer(names, "<i8"), count[1:])]))
        if told:
            told, who, marked = np.concatenate(told), np.concatenate(who), np.concatenate(marked)
            order = np.lexsort((who, told))
            told, who, marked = told[order], who[order], marked[order]
            new = np.append(True, told[1:] != told[:-1])
            group = np.cumsum(new) - 1
            other = np.append(False, (told[1:] == told[:-1]) & (who[1:] != who[:-1]))
            shared = (np.bincount(group, other) + np.bincount(group, marked)) > 0
            name, count = np.unique(who[shared[group] & ~marked], return_counts=True)
            zero = np.zeros_like(name)
            out.append(np.vstack([zero + HITS, zero, zero, name, count]))
        block = np.hstack(out) if out else np.zeros((5, 0), np.int64)
        return pa.table([pa.array(c.astype(np.int64)) for c in block], ["kind", "doc_id", "known", "name", "n"])

    told = texts(docs, "doc_id", "text").mapInArrow(tell, ENTRY)
    return told.groupBy("bucket").applyInArrow(weigh, "kind long, doc_id long, known long, name long, n long")


CHUNK = "chunk long, names binary, sizes binary, lengths binary, grams binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """The whole n-gram sets of documents, a row for many."""

    def chunk(number: int, held: dict[int, np.ndarray]) -> pa.RecordBatch:
        lengths = np.array([len(g) for g in held.values()], "<i8").tobytes()
        row = [number, np.array([*held], "<i8").tobytes(), lengths, lengths, np.concatenate([*held.values()]).astype("<u8").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["chunk", "names", "sizes", "lengths", "grams"])

    def run(batches):
        part, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            held: dict[int, np.ndarray] = {}
            size = 0
            for grams in gram_sets(batch.column("body").to_pylist()):
                if len(grams):
                    held[set_name(grams)] = grams
                    size += len(grams)
                if size >= CHUNK_GRAMS:
                    yield chunk(part << 32 | turn, held)
                    held, size, turn = {}, 0, turn + 1
            if held:
                yield chunk(part << 32 | turn, held)
                turn += 1

    return texts(docs, "doc_id", "text").mapInArrow(run, CHUNK)


def _unpack(row: dict) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(row[c], k) for c, k in (("names", "<i8"), ("lengths", "<i8"), ("grams", "<u8")))


SET = "hub long, name long, n long, hubs array<long>, grams binary"


def _ordered(chunks: DataFrame, buckets: int) -> DataFrame:
    """A row per set and hub: the n-grams that other sets have too, rarest first."""

    def tell(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names, lengths, grams = _unpack(row)
                owner = np.repeat(names, lengths)
                order = np.lexsort((owner, grams))
                grams, owner = grams[order], owner[order]
                first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
                times = np.diff(np.append(first, len(grams)))
                grams, owner = grams[first], owner[first]  # the smallest name of each n-gram
                bucket = (grams >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                rows = []
                for b in np.flatnonzero(np.diff(cuts)):
                    at = order[cuts[b] : cuts[b + 1]]
                    rows.append((int(b), row["chunk"], owner[at].astype("<i8").tobytes(), times[at].astype("<u4").tobytes(), grams[at].astype("<u8").tobytes()))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[2:])],
                    ["bucket", "chunk", "names", "counts", "grams"],
                )

    def count(key, table):
        chunk = table.column("chunk").to_numpy()
        parts = [[np.frombuffer(x, k) for x in table.column(c).to_pylist()] for c, k in (("grams", "<u8"), ("names", "<i8"), ("counts", "<u4"))]
        home = np.repeat(chunk, [len(g) for g in parts[0]])
        grams, names, counts = (np.concatenate(p) for p in parts)
        unique, inverse = np.unique(grams, return_inverse=True)
        total = np.bincount(inverse, counts).astype(np.int64)
        hub = np.full(len(unique), np.iinfo(np.int64).max)
        np.minimum.at(hub, inverse, names)
        keep = np.flatnonzero(total[inverse] > 1)
        keep = keep[np.argsort(home[keep], kind="stable")]
        homes, first = np.unique(home[keep], return_index=True)
        rows = []
        for at in np.split(keep, first[1:]) if len(keep) else []:
            which = inverse[at]
            rows.append((grams[at].astype("<u8").tobytes(), total[which].astype("<u4").tobytes(), hub[which].astype("<i8").tobytes()))
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(homes, pa.int64()), *(pa.array(c, pa.binary()) for c in columns)], ["chunk", "grams", "counts", "hubs"])

    def order(key, sets, counts):
        out = []
        shared, total, hub = (
            np.concatenate([np.frombuffer(x, k) for x in counts.column(c).to_pylist()] or [np.zeros(0, k)])
            for c, k in (("grams", "<u8"), ("counts", "<u4"), ("hubs", "<i8"))
        )
        by_gram = np.argsort(shared)
        shared, total, hub = shared[by_gram], total[by_gram], hub[by_gram]
        for row in sets.to_pylist() if len(shared) else []:
            names, lengths, grams = _unpack(row)
            at = np.minimum(np.searchsorted(shared, grams), len(shared) - 1)
            there = shared[at] == grams
            ends = np.cumsum(lengths)
            for name, n, end in zip(names.tolist(), lengths.tolist(), ends.tolist()):
                place = at[end - n : end][there[end - n : end]]
                place = place[np.lexsort((shared[place], total[place]))]
                prefix = n - needed(n) + 1 - (n - len(place))  # n-grams of no other set come first
                if prefix > 0:
                    hubs = np.unique(hub[place[:prefix]]).tolist()
                    packed = np.stack([total[place].astype("<u8"), shared[place]]).tobytes()
                    out += [(h, name, n, hubs, packed) for h in hubs]
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["hub", "name", "n", "hubs", "grams"])

    told = chunks.mapInArrow(tell, "bucket int, chunk long, names binary, counts binary, grams binary")
    counted = told.groupBy("bucket").applyInArrow(count, "chunk long, grams binary, counts binary, hubs binary")
    return chunks.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(order, SET)


def _search(sets: DataFrame, weights: DataFrame, partitions: int) -> DataFrame:
    """(name, links, root) of sets with links, from every pair of blocks of every hub."""

    def links_of(rows: list[dict]) -> list[tuple[int, int, int]]:
        hub = rows[0]["hub"]
        left, right = rows[0]["low"], rows[0]["high"]
        unique: dict[int, dict] = {}
        for row in rows:
            unique[row["name"]] = row
        rows = list(unique.values())
        rows_a = [i for i, r in enumerate(rows) if r["block"] == left]
        rows_b = [i for i, r in enumerate(rows) if r["block"] == right]
        if not rows_a or not rows_b or len(rows) < 2:
            return []
        # One number per n-gram, in the global order of (count, n-gram).
        packed = [np.frombuffer(r["grams"], "<u8").reshape(2, -1) for r in rows]
        total, gram = np.hstack(packed)
        order = np.lexsort((gram, total))
        new = np.append(True, (gram[order][1:] != gram[order][:-1]) | (total[order][1:] != total[order][:-1]))
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        grams = np.split(number, np.cumsum([p.shape[1] for p in packed])[:-1])
        sizes = np.array([r["n"] for r in rows])
        lower = [{h for h in r["hubs"] if h < hub} for r in rows]
        links, parent = [0] * len(rows), list(range(len(rows)))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        got = overlaps([grams[i] for i in rows_a], sizes[rows_a], [grams[i] for i in rows_b], sizes[rows_b])
        for a, found in got:
            a = rows_a[a]
            for b in found.tolist():
                b = rows_b[b]
                if left == right and b <= a or lower[a] and lower[b] and not lower[a].isdisjoint(lower[b]):
                    continue
                links[a] += rows[b]["copies"]
                links[b] += rows[a]["copies"]
                parent[find(b)] = find(a)
        smallest: dict[int, int] = {}
        for i in range(len(rows)):
            root = find(i)
            smallest[root] = min(smallest.get(root, rows[i]["name"]), rows[i]["name"])
        return [(rows[i]["name"], links[i], smallest[find(i)]) for i in range(len(rows)) if links[i]]

    def run(batches):
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and (held[0]["hub"], held[0]["low"], held[0]["high"]) != (row["hub"], row["low"], row["high"]):
                    out += links_of(held)
                    held = []
                held.append(row)
            yield _links(out)
        yield _links(links_of(held) if held else [])

    blocks = sets.groupBy("hub").agg(F.count(F.lit(1)).alias("sets"), F.sum(F.octet_length("grams") / 16).alias("grams_in"))
    blocks = blocks.filter("sets > 1").select(
        "hub", F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("grams_in") / BLOCK_GRAMS)).cast("long").alias("blocks")
    )
    blocks = small(stored(blocks, new_folder(sets.sparkSession, "hub-blocks")), 16)
    block = F.pmod(F.xxhash64("name"), F.col("blocks"))
    rows = sets.join(blocks, "hub").join(weights, "name").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    rows = rows.select("hub", "low", "high", "block", "name", "n", "copies", "hubs", "grams")
    rows = rows.repartition(partitions, "hub", "low", "high").sortWithinPartitions("hub", "low", "high", "name")
    return rows.mapInArrow(run, "name long, links long, root long")


def _links(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["name", "links", "root"])


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (other rows linked) of every row."""
    return _similar(docs, key, text).drop("name")


def _similar(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The same with the name of the row's set, null without words."""
    spark = docs.sparkSession
    folder = new_folder(spark, "ngram-join")
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    partitions = shuffle_partitions(spark)
    screened = stored(_screen(docs, max(partitions, -(-chars // BUCKET_CHARS))), f"{folder}/screen")
    rows = screened.filter(F.col("kind") == DOCUMENT).select(F.when(F.col("known") == 1, F.col("doc_id")).alias("doc_id"), "name", "n")
    sets = rows.filter("n > 0").groupBy("name").agg(F.max("n").alias("n"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    sets = stored(sets, f"{folder}/sets")
    hits = screened.filter(F.col("kind") == HITS).groupBy("name").agg(F.sum("n").alias("hits"))
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * NEEDED / 100) / 10))  # of a linked set that is smaller
    found = stored(sets.join(hits, "name").filter(F.col("hits") >= least), f"{folder}/screened-sets")

    wanted = small(found.select(F.col("least").alias("wanted")).distinct(), 16)
    chunks = stored(_chunks(docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")), f"{folder}/chunks")
    grams = chunks.agg(F.sum(F.octet_length("grams") / 8)).first()[0] or 0
    ordered = stored(_ordered(chunks, max(partitions, -(-int(grams) // BUCKET_GRAMS))), f"{folder}/ordered")
    weights = small(found.select("name", "copies"), 24)
    linked = stored(_search(ordered, weights, partitions), f"{folder}/links")

    classes = components(linked.select(F.col("name").alias("a"), F.col("root").alias("b")), f"{folder}/classes")
    links = linked.groupBy("name").agg(F.sum("links").alias("links"))
    sets = sets.join(classes.withColumnRenamed("node", "name"), "name", "left").join(links, "name", "left")
    sets = sets.withColumn("class", F.coalesce("root", "name"))
    least = sets.groupBy("class").agg(F.min("least").alias("component_id"))
    sets = sets.join(least, "class").select("name", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = rows.filter("n > 0").join(stored(sets, f"{folder}/set-classes"), "name")
    known = known.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", "name")
    empty = rows.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("name"))
    return known.unionByName(empty)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without those whose class has a row of smaller key.

    Rows without words or key stay. Rows that repeat key and text are one document: one stays. Rows
    that repeat a key with other texts are judged each by the class of its own text. Columns may have any names.
    """
    found = stored(_similar(docs, key, text), new_folder(docs.sparkSession, "similar"))
    rows = docs.select(F.struct("*").alias("row"))
    own = F.col("row").getField(key).cast("long")
    twice = found.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    repeated = None
    if not twice.isEmpty():
        twice = small(stored(twice, new_folder(docs.sparkSession, "repeated")), 16)
        repeated = _judged(rows.join(twice, own == F.col("doc_id"), "left_semi"), found, key, text)
        rows = rows.join(twice, own == F.col("doc_id"), "left_anti")
    dropped = found.filter("doc_id <> component_id").select("doc_id").distinct()
    dropped = small(stored(dropped, new_folder(docs.sparkSession, "dropped")), 16)
    kept = rows.join(dropped, own == F.col("doc_id"), "left_anti")
    return (kept.unionByName(repeated) if repeated else kept).select("row.*")


def _judged(rows: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """Of rows whose key is repeated, one of each text whose set's class has no smaller key."""

    def name(batches):
        for batch in batches:
            sets = gram_sets([(t or "").encode() for t in batch.column("of_text").to_pylist()])
            names = pa.array([set_name(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, names], ["of_key", "of_text", "name"])

    rows = rows.select("row", F.col("row").getField(key).cast("long").alias("of_key"), F.col("row").getField(text).alias("of_text"))
    rows = rows.dropDuplicates(["of_key", "of_text"])
    named = rows.select("of_key", "of_text").mapInArrow(name, "of_key long, of_text string, name long")
    worse = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("of_key"), "name").distinct()
    worse = named.join(worse, ["of_key", "name"], "left_semi").select(F.col("of_key").alias("key"), F.col("of_text").alias("text"))
    return rows.join(worse, (F.col("of_key") == F.col("key")) & F.col("of_text").eqNullSafe(F.col("text")), "left_anti").select("row")
