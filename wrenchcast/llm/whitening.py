"""Operator 13: embedding whitening by blockwise QR, bidiagonalisation, dqds and twisted factorisations.

Every entry c becomes the integer x = floor(64 c) + 1,000,000. Four distributed passes over the vectors:

1. count n and integer sums S per dimension, as partial sums per task;
2. rows (n x - S) / n (the difference is exact) are reduced to a triangular factor block by block in each task, and the
   tasks' factors in groups of ``FAN`` until one is left: it has the side of the dimensions whatever the number of rows;
3. the covariance of the whitened rows, as partial sums per task;
4. the rows themselves.

Between 2 and 3 the driver bidiagonalises that one factor, finds its singular values by dqds and their vectors by
twisted factorisations (``bidiagonal``). It holds dims x dims doubles and ships dims x ``most``: bounded by the length of
a vector, not by rows. Nothing is shuffled but sums and factors, so equal or hot vectors cost what others do.

Defined results: rows whose vector is null, or holds a null, non-finite or too large entry (64 c beyond 2**62), are
dropped, as are rows whose vector's length is not the commonest one (of equally common ones the longest); an empty
vector counts as null. Components whose variance is not above 1e-12 of the first one's are not returned (none at all if
all vectors are equal, and then the result is empty, as for an empty table). Of equal variances any orthogonal directions
are taken, the same for all rows. Rows repeated and null ids count as rows. A deviation too large for a long is null.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bidiagonal import right_vectors
from .common import cut, fresh, map_batches

FAN = 8
SCALE, ORIGIN = 64, 1_000_000
_LIMIT = 2.0 ** 62
_BLOCK = 1 << 22  # entries handled at a time


def integers(vectors: pa.Array, dims: int) -> np.ndarray:
    """x of each vector, a row each."""
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat.reshape(-1, dims)).astype(np.int64) + ORIGIN)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    step = max(1, _BLOCK // dims)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def scaled_deviation(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs if they hold it, else Python's integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 2**63:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squared_length(deviation: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None where a long cannot hold it."""
    most = int(np.abs(deviation).max(initial=0))
    if deviation.dtype != object and most * most * deviation.shape[1] < 2**63:
        return (deviation * deviation).sum(axis=1).tolist()
    exact = (deviation.astype(object) ** 2).sum(axis=1)
    return [int(s) if s < 2**63 else None for s in exact]


def usable(table: DataFrame, vector: str, keep: list[str]) -> tuple[DataFrame, int]:
    """``keep`` and the vector (as doubles) of the usable rows, and their length (0 without any)."""
    kept, v = fresh(keep, "vector")[0], F.col(f"`{vector}`").cast("array<double>")
    good = F.forall(v, lambda c: F.coalesce(F.abs(c * SCALE) < F.lit(_LIMIT), F.lit(False)))  # false for NaN
    rows = table.select(*[F.col(f"`{c}`") for c in keep], v.alias(kept)).where(
        F.col(kept).isNotNull() & (F.size(kept) > 0)).where(good)
    lengths = rows.groupBy(F.size(kept).alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("dims")).head()  # one row per length of a vector
    dims = common["dims"] if common else 0
    return rows.where(F.size(kept) == dims), dims


def _sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, dtype=object)
        for part in _blocks(batches, dims):
            x = integers(part.column(0), dims)
            n += len(x)
            small = int(np.abs(x).max(initial=0)) * len(x) < 2**63
            total += (x if small else x.astype(object)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(dims), -1], pa.int32()),
             pa.array([*map(Decimal, total.tolist()), Decimal(n)], pa.decimal128(38, 0))], ["dim", "s"])
    sums = {r["dim"]: int(r["s"]) for r in
            map_batches(vectors, run, "dim int, s decimal(38,0)").groupBy("dim").agg(F.sum("s").alias("s")).collect()}
    return sums.get(-1, 0), [sums.get(k, 0) for k in range(dims)]


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _factor(vectors: DataFrame, dims: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.empty((0, dims))
        for part in _blocks(batches, dims):
            centred = scaled_deviation(integers(part.column(0), dims), n, sums).astype(float) / n
            r = _triangle(np.vstack([r, centred]))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                          pa.array([r.tobytes()], pa.binary())], ["block", "r"])

    def merge(frame):
        stacked = [np.frombuffer(x).reshape(-1, dims) for x in frame.sort_values("block")["r"]]
        frame = frame.head(1).copy()
        frame["block"], frame["r"] = frame["block"] // FAN, [_triangle(np.vstack(stacked)).tobytes()]
        return frame

    blocks = cut(map_batches(vectors, first, "block long, r binary"))
    left = (blocks.agg(F.max("block")).head()[0] or 0) + 1
    while left > 1:
        blocks = blocks.groupBy(F.floor(F.col("block") / FAN).alias("group")).applyInPandas(merge, "block long, r binary")
        left = -(-left // FAN)
    r = np.zeros((dims, dims))
    for row in blocks.collect():  # the one factor that is left
        part = np.frombuffer(row["r"]).reshape(-1, dims)
        r[:len(part)] = part
    return r


def whiten(table: DataFrame, vector: str = "embedding", row_id: str = "vec_id", most: int = 32) -> DataFrame:
    """A row for each usable row and component (see the module): id, component, n, deviation, whitened, explained,
    identity_error."""
    rows, dims = usable(table, vector, [row_id])
    name = rows.columns[-1]
    schema = (f"`{row_id}` {table.schema[row_id].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    vectors = rows.select(name)
    n, sums = _sums(vectors, dims) if dims else (0, [])
    if not n:
        return table.sparkSession.createDataFrame([], schema)
    squares, directions = right_vectors(_factor(vectors, dims, n, sums), most)
    found = directions.shape[1]
    explained = (squares[:found] / squares.sum()).tolist() if found else []
    turn = directions / np.sqrt(squares[:found] / n)

    def white(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        deviation = scaled_deviation(integers(part, dims), n, sums)
        return deviation, deviation.astype(float) / n @ turn

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(found), np.zeros((found, found))
        for part in _blocks(batches, dims):
            w = white(part.column(0))[1]
            total += w.sum(axis=0)
            product += w.T @ w
        i, j = np.indices((found, found + 1))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                          pa.array(np.column_stack([product, total]).ravel())], ["i", "j", "s"])

    covariance = np.zeros((found, found + 1))
    for r in map_batches(vectors, moments, "i int, j int, s double").groupBy("i", "j").agg(
            F.sum("s").alias("s")).collect():  # at most ``most`` times ``most`` + 1 sums
        covariance[r["i"], r["j"]] = r["s"] / n
    mean = covariance[:, found]
    error = float(np.abs(covariance[:, :found] - np.outer(mean, mean) - np.eye(found)).max(initial=0.0))

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches, max(dims, found)):
            deviation, w = white(part.column(1))
            size = len(w) * found
            lengths = pa.array(squared_length(deviation), pa.int64())
            each = pa.array(np.repeat(np.arange(len(w)), found))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(each), pa.array(np.tile(np.arange(1, found + 1), len(w)), pa.int32()),
                 pa.array(np.full(size, n)), lengths.take(each), pa.array(w.ravel()),
                 pa.array(np.tile(explained, len(w))), pa.array(np.full(size, error))],
                [row_id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_batches(rows, result, schema) if found else table.sparkSession.createDataFrame([], schema)
