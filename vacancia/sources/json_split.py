"""Records of JSON-array files in any layout, each file read by many tasks.

A file is read in blocks (Spark's file splits) that begin and end behind a closing brace. What a block does
to the state of a reader is a function of two values: inside a string or not, and how many brackets are open.

1. Functions. Every block is scanned once for both beginnings, without knowing which is true.
2. States. Per file the blocks' functions are applied one after the other, which gives every block's
   beginning. Only these numbers meet in one task, one row per block.
3. Records. Blocks are read again from their true beginning: whole records leave at once, the parts
   at a block's ends are joined with those of its neighbours. No text but those parts is shuffled. Files of
   one block have no such parts.

Files are told apart by joins, never by lists of names in an expression or a closure: there may be any number.

A file holds a record with a lost quote or bracket if its array does not close or closes too early, or if
something else than `,`, `:` or a bracket stands behind the end of a string. Such a file is scanned once more with one more rule: `},{"k":1,"m"`, where k and m are the first keys of the file's
first record, begins a record whatever the state. So one bad record costs one record as long as records
begin with the same keys, and sound files do not depend on that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.context import materialize

FRAGMENT_END = "}"
#: What may stand between records.
_BETWEEN = b" \t\r\n,[]"
_BOM = b"\xef\xbb\xbf"
_STRING, _SCALAR = rb'"(?:[^"\\]|\\.)*"', rb'(?:"(?:[^"\\]|\\.)*"|[^,"{}\[\]]*)'
#: The first keys of a file's first record.
_FIRST_KEYS = re.compile(rb"^\s*\[\s*\{\s*(" + _STRING + rb")\s*:(?:\s*" + _SCALAR + rb"\s*,\s*(" + _STRING + rb"))?")
#: Starts of blocks are broadcast up to this size.
BROADCAST_BYTES = 64 << 20
#: Bytes that are scanned at once.
SCAN_BYTES = 1 << 20

FILE_COLUMNS = ["_source_file", "_file_size", "_file_mtime"]


def fragments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """What stands between closing braces, in the order of the file within a block."""
    return (
        spark.read.option("lineSep", FRAGMENT_END)
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_size").alias("_file_size"),
            F.col("_metadata.file_modification_time").alias("_file_mtime"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("value").cast("binary").alias("value"),
        )
    )


# --- scanning -----------------------------------------------------------------------------------


#: What may stand behind a string.
_BEHIND = np.isin(np.arange(256), list(b" \t\r\n,:]}"))


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of brackets, +1 or -1 for each, quotes before each, and quotes; escaped quotes do not count."""
    quotes = np.flatnonzero(data == 0x22)
    slashes = np.flatnonzero(data == 0x5C)
    if len(slashes) and len(quotes):
        first = np.append(True, np.diff(slashes) != 1)
        run_start = np.maximum.accumulate(np.where(first, slashes, 0))
        at = np.searchsorted(slashes, quotes) - 1  # the last backslash before each quote
        touches = (at >= 0) & (slashes[at] == quotes - 1)
        escaped = touches & ((quotes - run_start[at]) % 2 == 1)
        quotes = quotes[~escaped]
    lower = data | 0x20  # brackets and braces differ in one bit
    places = np.flatnonzero((lower == 0x7B) | (lower == 0x7D))
    step = np.where(lower[places] == 0x7B, 1, -1)
    return places, step, np.searchsorted(quotes, places), quotes


def _first_keys(chunk: bytes) -> bytes | None:
    """The first keys of a file as a pattern, from its beginning."""
    found = _FIRST_KEYS.match(chunk.removeprefix(_BOM))
    if not found:
        return None
    key, following = found.groups()
    return re.escape(key) + rb"\s*:" + (rb"\s*" + _SCALAR + rb"\s*,\s*" + re.escape(following) if following else b"")


#: What begins a record for certain: at the start of a chunk, and behind a brace.
Marker = tuple[re.Pattern, re.Pattern]


def _marker(keys: bytes | None) -> Marker | None:
    begin = rb"\s*,\s*(\{)\s*"
    return (re.compile(begin + keys), re.compile(rb"\}" + begin + keys)) if keys else None


def _certain(chunk: bytes, marker: Marker | None) -> np.ndarray:
    """Places in a chunk where a record begins for certain."""
    if not marker:
        return np.zeros(0, np.int64)
    at_start, behind = marker
    first = at_start.match(chunk)
    found = [first.start(1)] if first else []
    found += [m.start(1) for m in behind.finditer(chunk, first.end() if first else 0)]
    return np.array(found, np.int64)


class _Effect:
    """What a text does to a reader that begins outside (0) or inside (1) a string.

    For each beginning: inside a string at the end, and brackets opened; `fixed` if the depth is absolute,
    `wrong` if a string ends where none can.
    """

    def __init__(self):
        self.inside, self.depth, self.fixed, self.wrong = [0, 1], [0, 0], [False, False], [False, False]

    def add(self, chunk: bytes, marker: Marker | None):
        data, certain = np.frombuffer(chunk, np.uint8), _certain(chunk, marker)
        places, step, before, quotes = _marks(data)
        behind = _BEHIND[data[np.minimum(quotes + 1, len(data) - 1)]]
        # Up to the first certain beginning the state is that of the text before; behind it, it is known.
        known = int(certain[0]) if len(certain) else len(data)
        n, m = np.searchsorted(quotes, known), np.searchsorted(places, known)
        self._follow(step[:m], before[:m], behind[:n])
        if len(certain):
            first = np.searchsorted(quotes, certain)
            index = np.arange(n, len(quotes))
            closing = (index - first[np.searchsorted(first, index, "right") - 1]) & 1 == 1
            wrong = not behind[n:][closing].all()
            self.wrong = [w or wrong for w in self.wrong]
            self.inside, self.depth, self.fixed = [0, 0], [1, 1], [True, True]
            m = np.searchsorted(places, certain[-1])
            self._follow(step[m:], before[m:] - first[-1], behind[first[-1] :])

    def _follow(self, step: np.ndarray, before: np.ndarray, behind: np.ndarray):
        odd = before & 1
        opened = [int(step[odd == 0].sum()), int(step[odd == 1].sum())]
        wrong = [not behind[1::2].all(), not behind[0::2].all()]
        for s in (0, 1):
            self.wrong[s] |= wrong[self.inside[s]]
            self.depth[s] += opened[self.inside[s]]
            self.inside[s] ^= len(behind) & 1

    def row(self) -> list[int]:
        return [*self.inside, *self.depth, *map(int, self.fixed), *map(int, self.wrong)]


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """First and last row (exclusive) of each run of rows of one block."""
    changed = np.zeros(max(batch.num_rows - 1, 0), bool)
    for name in ("_source_file", "_block"):
        column = batch.column(name)
        changed |= pc.not_equal(column.slice(1), column.slice(0, len(changed))).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    return [(begin, end) for begin, end in zip(edges, edges[1:]) if begin < end]


def _by_block(batches, names: list[str]) -> Iterator[tuple[tuple, list[bytes], bool]]:
    """(values of `names`, fragments, last of the block) in pieces of bounded size; rows come in order.

    `names` hold one value per block and begin with the file and the block.
    """
    held, texts, size = None, [], 0
    for batch in batches:
        for begin, end in _runs(batch):
            head = tuple(batch.column(n)[begin].as_py() for n in names)
            if held is not None and head[:2] != held[:2]:
                yield held, texts, True
                texts, size = [], 0
            held = head
            for value in batch.column("value").slice(begin, end - begin).to_pylist():
                if size >= SCAN_BYTES:
                    yield held, texts, False
                    texts, size = [], 0
                texts.append(value)
                size += len(value)
    if held is not None:
        yield held, texts, True


def _lay(pieces: DataFrame, table: DataFrame, rows: int, on: list[str]) -> DataFrame:
    """Pieces whose file or block is in `table`, with its columns; blocks stay in order."""
    if rows * 200 <= BROADCAST_BYTES:
        return pieces.join(F.broadcast(table), on)
    laid = pieces.withColumn("_row", F.monotonically_increasing_id()).join(table, on)
    return laid.repartition("_source_file", "_block").sortWithinPartitions("_source_file", "_block", "_row").drop("_row")


EFFECT = "_source_file string, _block long, _file_size long, bytes long, key binary, inside0 int, inside1 int, depth0 int, depth1 int, fixed0 int, fixed1 int, wrong0 int, wrong1 int"


def _effects(pieces: DataFrame) -> DataFrame:
    """EFFECT of every block; `bytes` counts a closing brace behind every fragment.

    `key` of the pieces, if they have it, is the pattern of what begins a record for certain.
    """
    names = ["_source_file", "_block", "_file_size", *(["key"] if "key" in pieces.columns else [])]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int32()] * 8]

    def run(batches):
        effect, total, key = _Effect(), 0, None
        for (file, block, size, *begins), texts, last in _by_block(batches, names):
            chunk = b"}".join(texts) + b"}"
            if not total and not block:
                key = _first_keys(chunk)
            effect.add(chunk, _marker(begins[0]) if begins else None)
            total += len(chunk)
            if last:
                row = [file, block, size, total, key, *effect.row()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [c.split()[0] for c in EFFECT.split(", ")])
                effect, total, key = _Effect(), 0, None

    return pieces.select(*names, "value").mapInArrow(run, EFFECT)


START = "_source_file string, _block long, inside int, depth int, open_end boolean, last boolean, several boolean, ends_well boolean, sound boolean, key binary"


def _follow_file(blocks: list[dict]) -> list[dict]:
    """START rows of one file from the EFFECT rows of its blocks, in their order."""
    inside, depth, wrong, begins = 0, 0, False, []
    for b in blocks:
        begins.append((inside, depth))
        wrong |= bool(b[f"wrong{inside}"])
        depth = b[f"depth{inside}"] + (0 if b[f"fixed{inside}"] else depth)
        inside = b[f"inside{inside}"]
    # A byte order mark is not among the fragments.
    unended = sum(b["bytes"] for b in blocks) - blocks[0]["_file_size"] in (1, 1 - len(_BOM))
    if unended and not inside:
        depth += 1  # the brace counted behind the last fragment is not there
    ends_well = not inside and depth == 0
    of_file = {"several": len(blocks) > 1, "ends_well": ends_well, "sound": ends_well and not wrong, "key": blocks[0]["key"]}
    return [
        {"_source_file": b["_source_file"], "_block": b["_block"], "inside": s, "depth": d,
         "open_end": unended and b is blocks[-1], "last": b is blocks[-1], **of_file}
        for b, (s, d) in zip(blocks, begins)
    ]


def _starts(effects: DataFrame) -> DataFrame:
    """START of every block: its beginning, whether it is the file's last, and whether the file ends there without a brace.

    Of the whole file: whether it has several blocks, whether its array closes, whether it is sound, and a
    pattern of its first keys. Rows come by file, so a file costs a loop over its blocks and no more.
    """
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in START.split(", "))])

    def run(batches):
        held = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and held[0]["_source_file"] != row["_source_file"]:
                    out += _follow_file(held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist(_follow_file(held), schema)

    return effects.repartition("_source_file").sortWithinPartitions("_source_file", "_block").mapInArrow(run, START)


# --- records ------------------------------------------------------------------------------------

#: Kinds of pieces: whole; the end of a record begun in an earlier block; a record that goes on in the next.
WHOLE, HEAD, TAIL = range(3)
_ENDS, _CERTAIN, _OPENS = range(3)


class _Cutter:
    """Cuts a block into records, from its true beginning."""

    def __init__(self, inside: int, depth: int, marker: Marker | None):
        self.inside, self.depth, self.marker = inside, depth, marker
        self.out: list[tuple[int, bytes]] = []
        self.open: list[bytes] | None = [] if depth > 1 or inside else None
        self.earlier = self.open is not None  # the open record began in an earlier block
        self.between: list[bytes] = []

    def _close(self, kind: int | None = None):
        if self.open is not None:
            text = b"".join(self.open)
            kind = (HEAD if self.earlier else WHOLE) if kind is None else kind
            self.out.append((kind, text))
        self.open, self.earlier = None, False

    def _end_between(self):
        text = b"".join(self.between).removeprefix(_BOM).strip(_BETWEEN)
        if text:
            self.out.append((WHOLE, text))
        self.between = []

    def add(self, chunk: bytes):
        data, certain = np.frombuffer(chunk, np.uint8), _certain(chunk, self.marker)
        places, step, before, quotes = _marks(data)
        # Behind a certain beginning quotes and brackets are counted from there.
        first, part = np.searchsorted(quotes, certain), np.searchsorted(certain, places, "right")
        outside = ((before - np.append(-self.inside, first)[part]) & 1) == 0
        places, step, part = places[outside], step[outside], part[outside]
        opened = np.append(0, np.cumsum(step))
        at_first = opened[np.searchsorted(places, certain)]
        depth = opened[1:] + np.append(self.depth, 1 - at_first)[part]
        brace = data[places] & 0x20 > 0 if len(places) else np.zeros(0, bool)
        starts = places[brace & (step == 1) & (depth == 2)]
        ends = places[brace & (step == -1) & (depth == 1)] + 1
        edges = np.concatenate([ends, certain, starts])
        kinds = np.repeat([_ENDS, _CERTAIN, _OPENS], [len(ends), len(certain), len(starts)])
        order = np.argsort(edges, kind="stable")  # a certain beginning comes before the record that opens there
        at = 0
        for edge, kind in zip(edges[order].tolist(), kinds[order].tolist()):
            if kind == _OPENS and self.open is None:
                self.between.append(chunk[at:edge])
                self._end_between()
                self.open = []
                at = edge
            elif kind == _ENDS and self.open is not None:
                self.open.append(chunk[at:edge])
                self._close()
                at = edge
            elif kind == _CERTAIN:
                (self.between if self.open is None else self.open).append(chunk[at:edge])
                self._close()  # a record that never closed
                at = edge
        (self.between if self.open is None else self.open).append(chunk[at:])
        counted = len(quotes) - int(first[-1]) if len(first) else len(quotes) + self.inside
        self.inside = counted & 1
        self.depth = int(opened[-1]) + (1 - int(at_first[-1]) if len(certain) else self.depth)

    def finish(self, last: bool):
        self._end_between()
        if self.open is not None:
            self._close(HEAD if self.earlier else WHOLE if last else TAIL)


PIECE = "_source_file string, _file_size long, _file_mtime timestamp, _block long, kind int, value binary"


def _cut(pieces: DataFrame, starts: DataFrame, rows: int) -> DataFrame:
    """PIECE rows of the blocks in `starts`: values are records, or what stands between them and is none.

    A block without any end of a record is one HEAD, whose record goes on in the next block.
    """
    on = ["_source_file", "_block"]
    names = [*on, "_file_size", "_file_mtime", "inside", "depth", "open_end", "ends_well", "key", "last"]
    zone = pieces.sparkSession.conf.get("spark.sql.session.timeZone")
    types = [pa.string(), pa.int64(), pa.timestamp("us", zone), pa.int64()]

    def run(batches):
        cutter = None
        for head, texts, done in _by_block(batches, names):
            file, block, size, mtime, inside, depth, open_end, ends_well, key, last = head
            if cutter is None:
                cutter = _Cutter(inside, depth, _marker(key))
            cutter.add(b"}".join(texts) + (b"" if done and open_end else b"}"))
            if done:
                cutter.finish(last)
            out, cutter.out = cutter.out, []
            if done and last and ends_well:
                out.append((WHOLE, b""))  # stands for the bracket that closes the array
            if out:
                of_block = [pa.repeat(pa.scalar(v, t), len(out)) for v, t in zip((file, size, mtime, block), types)]
                cut = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([*of_block, *cut], [c.split()[0] for c in PIECE.split(", ")])
            if done:
                cutter = None

    return _lay(pieces, starts, rows, on).select(*names, "value").mapInArrow(run, PIECE)


def split_records(spark: SparkSession, paths: str | list[str], files: DataFrame | None = None, rows: int = 0) -> DataFrame:
    """Pieces of the files in `paths`, or of those in `files` (_source_file, `rows` of them): value and the columns of the file.

    A value is one record as an array of its own, `[` and `]` around it; text that is no record is given in
    the same way and does not parse. A file whose array closes has one more piece, a line with `]`.
    """
    pieces = fragments(spark, paths)
    if files is not None:
        pieces = _lay(pieces, files, rows, ["_source_file"])
    starts = materialize(_starts(_effects(pieces)))
    lost = starts.filter("NOT sound AND key IS NOT NULL AND _block = 0").select("_source_file", "key")
    found = lost.count()
    known = starts.withColumn("key", F.lit(None).cast("binary"))
    if found:
        again = _starts(_effects(_lay(pieces, lost, found, ["_source_file"])))
        starts = materialize(known.join(lost, "_source_file", "left_anti").select(*starts.columns).unionByName(again))
    else:
        starts = known
    blocks = {several: starts.filter(F.col("several") == several).count() for several in (False, True)}

    value = F.col("value").cast("string")
    closed = F.when(F.octet_length("value") == 0, F.lit("\n]")).otherwise(F.concat(F.lit("["), value, F.lit("]")))
    out = _cut(pieces, starts.filter("NOT several"), blocks[False]).select(*FILE_COLUMNS, "value")
    if blocks[True]:
        # Read twice below: kept, so that no text is cut twice.
        cut = materialize(_cut(pieces, starts.filter("several"), blocks[True]))
        whole = cut.filter(F.col("kind") == WHOLE).select(*FILE_COLUMNS, "value")
        parts = cut.filter(F.col("kind") != WHOLE)
        in_order = Window.partitionBy("_source_file").orderBy("_block", "kind")
        parts = parts.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(in_order))
        joined = parts.groupBy(*FILE_COLUMNS, "record").agg(F.array_sort(F.collect_list(F.struct("_block", "kind", "value"))).alias("parts"))
        joined = joined.select(*FILE_COLUMNS, F.aggregate("parts.value", F.lit(b""), lambda a, b: F.concat(a, b)).alias("value"))
        several = whole.unionByName(joined)
        out = out.unionByName(several) if blocks[False] else several
    return out.select(closed.alias("value"), *FILE_COLUMNS)
