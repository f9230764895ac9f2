"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

1. Blocks. Vectors are written once as matrices of whole numbers x = floor(64 * c) + 1000000, many to a
   row; their number n and the sums S per dimension are exact.
2. Steps. From a direction v, one job computes u = Xv and X'u over the centred rows (n * x - S) / n, with u
   made orthogonal to all earlier u. The earlier u are not stored: each is XW for a known small W. A job
   also measures what is left of the earlier u in the new one, and is repeated if that is not nothing.
   The driver holds directions of one vector's length, never anything as long as the table.
3. Components. The singular values of the small bidiagonal matrix over the square root of n are the
   deviations, its right vectors turn the directions into components. Steps end when the wanted
   components have converged or all dimensions are used; where a chain of products ends early (repeated
   or missing deviations), a new direction orthogonal to all others goes on.

Rows whose vector is null or has null or non-finite entries are dropped, and those of another length than
most (of equally many: the longest). Rows that repeat count as often as they stand. Components without
deviation are not returned: they cannot be whitened, so an empty table or equal vectors give no rows.
Scaled entries beyond 2^62 count as that; `deviation` is null where its exact value is no long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm.common import new_folder, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Vectors of a block at most.
BLOCK_ROWS = 4096
#: What may be left of earlier u in a new one before it is made orthogonal again.
LEFT_OVER = 1e-12
#: Relative size below which a product has ended; residual at which a component has converged.
ENDED, CONVERGED = 1e-11, 1e-14
_LIMIT = float(1 << 62)

BLOCK = "dims int, size int, kind string, ids array<long>, x binary"


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(64 * c) as the narrowest whole numbers that hold the block."""
    x = np.clip(np.floor(values.astype(np.float64) * SCALE), -_LIMIT, _LIMIT).astype(np.int64)
    top = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    return x.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if top <= np.iinfo(t).max))


def blocks(table: DataFrame, key: str, vector: str) -> DataFrame:
    """Usable vectors, of one length in a row."""

    def run(batches):
        for batch in batches:
            lists, keys = batch.column("vector"), batch.column("vec_id").to_numpy(zero_copy_only=False)
            known = np.array(batch.column("vec_id").is_valid().to_pylist(), bool)
            ends = lists.offsets.to_numpy()
            flat = lists.values
            entries = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
            lengths = np.diff(ends)
            usable = np.array(lists.is_valid().to_pylist(), bool) & (bad[ends[1:]] == bad[ends[:-1]])
            for dims in np.unique(lengths[usable]):
                rows = np.flatnonzero(usable & (lengths == dims))
                for at in np.array_split(rows, -(-len(rows) // BLOCK_ROWS)):
                    x = _whole(entries[ends[at][:, None] + np.arange(dims)])
                    ids = [int(keys[i]) if known[i] else None for i in at]
                    columns = [pa.array([int(dims)], pa.int32()), pa.array([len(at)], pa.int32()), pa.array([x.dtype.str]), pa.array([ids], pa.list_(pa.int64())), pa.array([x.tobytes()])]
                    yield pa.RecordBatch.from_arrays(columns, ["dims", "size", "kind", "ids", "x"])

    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, BLOCK)


def _matrices(batches, dims: int):
    for batch in batches:
        for size, kind, x in zip(*(batch.column(c).to_pylist() for c in ("size", "kind", "x"))):
            yield np.frombuffer(x, kind).reshape(size, dims)


def _summed(rows: DataFrame, work, length: int) -> np.ndarray:
    """The sum over all tasks of the vectors that `work` makes of their batches."""

    def run(batches):
        total = work(batches)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "value"])

    parts = rows.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(length)
    for row in parts.collect():  # as many as there are dimensions and steps
        out[row["at"]] = row["value"]
    return out


@dataclass(frozen=True)
class Whitening:
    """n, exact sums S of x, components (a column each), eigenvalues and trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def _centred(x: np.ndarray, offsets: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Rows less the mean; whole parts are subtracted first, so nothing is rounded away."""
    return (x.astype(np.int64) - offsets) - mean


def _offsets(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean of x less SHIFT as a whole part and the rest of [0, 1)."""
    sums = [s - n * SHIFT for s in sums]
    return np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])


def totals(held: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of x per dimension."""

    def run(batches):
        total = [0] * dims
        for x in _matrices(batches, dims):
            safe = x.astype(np.int64) if x.dtype.itemsize < 8 else x.astype(object)
            total = [a + int(b) for a, b in zip(total, safe.sum(0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([str(t) for t in total])], ["at", "total"])

    sums = held.mapInArrow(run, "at int, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["at"]: int(r["total"]) for r in sums.collect()}
    n = held.agg(F.sum("size")).first()[0] or 0
    return n, [found.get(i, 0) + n * SHIFT for i in range(dims)]


def bidiagonalise(held: DataFrame, n: int, sums: list[int], wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(directions V, bidiagonal B, squared size of X) with XV = UB for orthonormal U that are never stored."""
    dims = len(sums)
    offsets, mean = _offsets(n, sums)
    random = np.random.default_rng(13)
    v = _fresh(random, np.zeros((dims, 0)))
    V, W, T = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))  # directions, u = Xw, X'u
    alphas: list[float] = []
    betas: list[float] = []
    size = None
    while True:
        less = T.T @ v  # what X v has of each earlier u
        for _ in range(3):
            k = W.shape[1]

            def products(batches, v=v, W=W, less=less, k=k):
                out = np.zeros(dims + k + 2)
                for x in _matrices(batches, dims):
                    c = _centred(x, offsets, mean)
                    before = c @ W
                    u = c @ v - before @ less
                    out += np.concatenate([c.T @ u, before.T @ u, [u @ u, np.einsum("ij,ij->", c, c)]])
                return out

            got = _summed(held, products, dims + k + 2)
            t, left, squared = got[:dims], got[dims : dims + k], got[-2]
            size = got[-1] if size is None else size
            if squared <= ENDED**2 * size or not k or np.abs(left).max() <= LEFT_OVER * np.sqrt(squared):
                break
            less = less + left
        alpha = np.sqrt(squared)
        if alpha <= ENDED * np.sqrt(size):
            if not betas or betas[-1] == 0.0:
                break  # a direction chosen at random has no product: nothing is left
            # The chain ends in a direction that earlier u account for; go on with another one.
            V, W, T = np.column_stack([V, v]), np.column_stack([W, np.zeros(dims)]), np.column_stack([T, np.zeros(dims)])
            alphas.append(0.0)
            beta = 0.0
        else:
            w, t = (v - W @ less) / alpha, t / alpha
            V, W, T = np.column_stack([V, v]), np.column_stack([W, w]), np.column_stack([T, t])
            alphas.append(alpha)
            after = t - alpha * v
            for _ in range(2):
                after -= V @ (V.T @ after)
            beta = float(np.linalg.norm(after))
        if V.shape[1] == dims:
            break
        if beta <= ENDED * np.sqrt(size):
            beta, v = 0.0, _fresh(random, V)
        else:
            v = after / beta
            if len(alphas) >= 2 * wanted and _converged(alphas, betas, beta, wanted):
                break
        betas.append(beta)
    k = V.shape[1]
    B = np.diag(alphas) + np.diag(betas[: k - 1], 1) if k else np.zeros((0, 0))
    return V, B, size or 0.0


def _fresh(random: np.random.Generator, V: np.ndarray) -> np.ndarray:
    v = random.standard_normal(V.shape[0])
    for _ in range(2):
        v -= V @ (V.T @ v)
    return v / np.linalg.norm(v)


def _converged(alphas: list[float], betas: list[float], beta: float, wanted: int) -> bool:
    P, s, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
    return bool((beta * np.abs(P[-1, :wanted]) <= CONVERGED * s[0]).all())


def fit(held: DataFrame, dims: int, wanted: int = COMPONENTS) -> Whitening | None:
    """The first components of the vectors in `held`, all of one length; null without deviation."""
    n, sums = totals(held, dims)
    if not n or not dims:
        return None
    V, B, size = bidiagonalise(held, n, sums, wanted)
    if not len(B):
        return None
    _, s, Qt = np.linalg.svd(B)
    keep = np.flatnonzero(s > ENDED * np.sqrt(size))[:wanted]
    if not len(keep):
        return None
    return Whitening(n, sums, V @ Qt[keep].T, s[keep] ** 2 / n, size / n)


def identity_error(held: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    dims, k = model.components.shape
    offsets, mean = _offsets(model.n, model.sums)
    projection = model.projection

    def means(batches):
        return sum(((_centred(x, offsets, mean) @ projection).sum(0) for x in _matrices(batches, dims)), np.zeros(k))

    middle = _summed(held, means, k) / model.n

    def products(batches):
        total = np.zeros((k, k))
        for x in _matrices(batches, dims):
            white = _centred(x, offsets, mean) @ projection - middle
            total += white.T @ white
        return total.ravel()

    covariance = _summed(held, products, k * k).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """sum((n * x - S)^2) of each row, exactly."""
    shifted = [s - n * SHIFT for s in sums]
    far = n * float(np.abs(x.astype(np.float64)).max(initial=0)) + max(map(abs, shifted))
    if far * far * len(sums) < _LIMIT:
        return ((x.astype(np.int64) * n - np.array(shifted, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, shifted)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


ROW = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def apply(held: DataFrame, model: Whitening, error: float) -> DataFrame:
    """A row of ROW for each vector and component."""
    dims, k = model.components.shape
    offsets, mean = _offsets(model.n, model.sums)
    explained = model.values / model.trace

    def run(batches):
        for batch in batches:
            for ids, x in zip(batch.column("ids").to_pylist(), _matrices([batch], dims)):
                rows = len(ids)
                white = _centred(x, offsets, mean) @ model.projection
                deviations = _deviations(x, model.n, model.sums)
                each = np.repeat(np.arange(rows), k)
                columns = [
                    pa.array(ids, pa.int64()).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n)),
                    pa.array(deviations, pa.int64()).take(pa.array(each)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ROW.split(", ")])

    return held.mapInArrow(run, ROW)


def usable_blocks(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """Stored blocks of the most common vector length, and that length (0 if there are none)."""
    held = stored(blocks(table, key, vector), new_folder(table.sparkSession, "whitening"))
    most = held.groupBy("dims").agg(F.sum("size").alias("rows")).orderBy(F.desc("rows"), F.desc("dims")).first()
    dims = most["dims"] if most else 0
    return held.filter(F.col("dims") == dims), dims


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """Fit on all usable vectors and whiten them: ROW for each vector and its first components."""
    held, dims = usable_blocks(table, key, vector)
    model = fit(held, dims, wanted)
    if model is None:
        return _none(table.sparkSession)
    return apply(held, model, identity_error(held, model))


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ROW)
