"""Whitening of embeddings from the singular values of the centred rows.

Entries become whole numbers, so counts and sums are exact. Every task reduces
its centred rows to one triangle by QR, block after block; the triangles are
merged in rounds of ``FAN_IN``. The last triangle R (one row and column per
dimension) has the rows' singular values: ``qd`` makes it bidiagonal, finds
them by dqds and recovers the directions by twisted factorisations. The
covariance's eigenvalue is the squared singular value over the number of rows,
so it is never formed. On the driver: R, the sums and the directions, bounded
by the dimension.

Edge cases: vectors that are null or hold null, NaN or infinite entries are
dropped, empty ones too; rows with a null or repeated vec_id are rows of their
own. Components without variance (rank below eight, one row, equal rows) are
left out, so an empty or constant table gives no rows. Tied eigenvalues get any
orthonormal directions of their space, the same for all rows. Vectors of
different lengths, or entries whose whole number is no long, raise ValueError.
A deviation beyond a long is null. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import qd
from quayside.llm.common import map_arrow, map_groups, python_batches, stored

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
BLOCK = 1024              # rows of a QR block (or the dimension, if larger)
FAN_IN = 16               # triangles merged at a time


@dataclass(frozen=True)
class Whitening:
    """n rows with sums S per dimension; ``directions`` has a column per
    component, ``values`` the eigenvalues, ``trace`` the total variance."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    directions: np.ndarray
    trace: float


def usable(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): rows whose vector has finite entries only."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c)
                      & (F.abs(c) < F.lit(float("inf"))))
    return (embeddings.select(F.col(key).cast("long").alias("vec_id"),
                              F.col(vector).cast("array<double>").alias("v"))
            .filter(F.col("v").isNotNull() & (F.size("v") > 0) & finite))


def whole(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, one row each."""
    v = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d) * SCALE)
    if len(v) and np.abs(v).max() >= 2.0 ** 62:
        raise ValueError("an embedding's entry is too large for a whole number")
    return v.astype(np.int64) + OFFSET


def offsets(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S as doubles, rows' exact sums of its squares as a nullable object
    array). Whole-number steps wrap around, and are used where they can't."""
    total = np.array(sums, float)
    rough = x.astype(float) * n - total
    wrapped = (x.astype(np.uint64) * np.uint64(n)
               - np.array([s % 2**64 for s in sums], np.uint64))
    exact = np.abs(rough) < 2.0 ** 62
    centred = np.where(exact, wrapped.astype(np.int64).astype(float), rough)
    size = np.square(centred).sum(axis=1)
    square = (wrapped * wrapped).sum(axis=1, dtype=np.uint64).astype(np.int64).astype(object)
    square[~((size < 2.0 ** 62) & exact.all(axis=1))] = None
    for i in np.flatnonzero((size >= 2.0 ** 62) & (size < 2.0 ** 64)):
        true = sum((n * a - s) ** 2 for a, s in zip(x[i].tolist(), sums, strict=True))
        square[i] = true if true < 2**63 else None
    return centred, square


def totals(vectors: DataFrame) -> tuple[int, tuple[int, ...]]:
    """(rows, exact sum of the whole numbers of each dimension)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            column = batch.column("v")
            size = np.diff(column.offsets.to_numpy())
            for d in np.unique(size).tolist():
                x = whole(column.filter(pa.array(size == d)), d)
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                held = found.setdefault(d, [0, 0, 0])
                found[d] = [held[0] + len(x), held[1] + high, held[2] + low]
        for d, (n, high, low) in found.items():
            yield pa.record_batch(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
                 pa.array([n] * d, pa.int64()), pa.array(high), pa.array(low)],
                names=["d", "at", "n", "high", "low"])

    python_batches(vectors.sparkSession)
    parts = vectors.select("v").mapInArrow(run, "d int, at int, n long, high long, low long")
    rows = (parts.groupBy("d", "at")
            .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
            .groupBy("d").agg(F.max("n").alias("n"),
                              F.sort_array(F.collect_list(F.struct("at", "high", "low")))
                              .alias("sums"))                 # one entry per dimension
            .limit(2).collect())
    if len(rows) > 1:
        raise ValueError("vectors of different lengths")
    if not rows:
        return 0, ()
    return rows[0]["n"], tuple((s["high"] << 32) + s["low"] for s in rows[0]["sums"])


def triangle(rows: np.ndarray, d: int) -> np.ndarray:
    """R of the rows' QR factorisation, filled up to d x d with zeros."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def reduced(vectors: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """The triangle of all centred rows."""
    d = len(sums)
    schema = "node int, r binary"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, held = None, []

        def fold():
            rows = held if r is None else [r, *held]
            return triangle(np.vstack(rows), d)

        for batch in batches:
            if batch.num_rows:
                held.append(offsets(whole(batch.column("v"), d), n, sums)[0] / n)
                if sum(map(len, held)) >= max(BLOCK, d):
                    r = fold()
                    held = []
        if held:
            r = fold()
        if r is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                   pa.array([r.tobytes()], pa.binary())], names=["node", "r"])

    def merge(group: pa.Table) -> pa.RecordBatch:
        r = None
        for one in group.column("r"):
            part = np.frombuffer(one.as_buffer(), float).reshape(d, d)
            r = part if r is None else triangle(np.vstack([r, part]), d)
        return pa.record_batch([group.column("node").combine_chunks()[:1],
                                pa.array([r.tobytes()], pa.binary())], names=["node", "r"])

    python_batches(vectors.sparkSession)
    level = stored(vectors.select("v").mapInArrow(blocks, schema), "triangles")
    while level.agg(F.max("node")).first()[0]:
        parents = level.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("int"))
        level = stored(map_groups(parents, ["node"], merge, schema), "triangles")
    return np.frombuffer(level.first()["r"], float).reshape(d, d)


def fit(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding",
        components: int = COMPONENTS) -> Whitening:
    """Directions of the largest variance of all usable vectors."""
    vectors = usable(embeddings, key, vector)
    n, sums = totals(vectors)
    if not n:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    r = reduced(vectors, n, sums)
    values, directions = qd.leading(r, components)
    return Whitening(n, sums, values ** 2 / n, directions, float(np.square(r).sum()) / n)


def whiten(embeddings: DataFrame, model: Whitening, key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """vec_id, deviation and ``whitened`` (array<double>, a component each) of
    every usable vector."""
    n, sums = model.n, model.sums
    project = model.directions / np.sqrt(model.values)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        centred, square = offsets(whole(batch.column("v"), len(sums)), n, sums)
        z = centred / n @ project
        k = z.shape[1]
        return pa.record_batch(
            [batch.column("vec_id"), pa.array(square.tolist(), pa.int64()),
             pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * k),
                                      pa.array(z.ravel()))],
            names=["vec_id", "deviation", "whitened"])

    rows = usable(embeddings, key, vector)
    if not n:
        rows = rows.limit(0)
    return map_arrow(rows, run, "vec_id long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity.

    The rows are centred, so only the rounding left in their mean is taken off
    the mean of products.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            z = batch.column("whitened").flatten().to_numpy().reshape(-1, k)
            z = np.hstack([z, np.ones((len(z), 1))])
            total += z.T @ z
        yield pa.record_batch([pa.array(np.arange(total.size, dtype=np.int32)),
                               pa.array(total.ravel())], names=["at", "value"])

    parts = whitened.select("whitened").mapInArrow(run, "at int, value double")
    rows = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()   # (k + 1)^2
    total = np.zeros((k + 1, k + 1))
    for row in rows:
        total.flat[row["at"]] = row["value"]
    mean = total[:k, k] / n
    return float(np.abs(total[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())


def components(embeddings: DataFrame, key: str = "vec_id",
               vector: str = "embedding") -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    model = fit(embeddings, key, vector)
    rows = whiten(embeddings, model, key, vector)
    k = len(model.values)
    error = identity_error(rows, model.n, k) if k else 0.0
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    if not k:
        rows, share = rows.limit(0), F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", share[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"))
