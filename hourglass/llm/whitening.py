"""Whitening of embeddings by spectral divide-and-conquer on polar decompositions.

Vectors are taken on the grid x = floor(256 c). The model is fitted on the distinct x, so
copies weigh nothing; every row is then projected on its leading components.

1. Rows become their x, packed to the least width that holds them, in one written stage.
   The distinct ones (pre-aggregated in every task, so a vector held by a third of the rows
   is no hot key) are a second, smaller stage.
2. Their number and exact sums, then their covariance: every task centres its vectors and
   adds up one d x d matrix; matrices are summed by cell. What reaches the driver is d sums
   and d (d + 1) / 2 cells, whatever the number of rows. d is the length of a vector.
3. Components on the driver, from the d x d matrix: the polar factor U of the covariance minus a
   shift has the eigenvalues +1 and -1, so (I + U) / 2 projects on the invariant subspace above
   the shift. U comes from dynamically weighted Halley steps with QR factorisations only. The
   covariance is restricted to either subspace and split again until a subspace has one
   dimension; only subspaces that hold a wanted component are split.
4. The d x 4 projection is broadcast and every row is whitened where it stands.

A null vector, one with a null or non-finite entry, an empty one, and one whose length is not the
most frequent (ties: the greater length) take no part. x saturates at +-2^62. Repeated rows give
repeated rows; a null vec_id stays null; an empty table gives no row; other columns are ignored.
``deviation`` is null where it exceeds a long. Components without variance (copies of
one vector, one row) have a null ``whitened``, and count as explained 0 (null if nothing varies).
"""

from __future__ import annotations

from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import map_arrow
from hourglass.session import materialize

GRID = 256
COMPONENTS = 4
SATURATE = 1 << 62
BATCH = 4096  # rows of one matrix product


# --- spectral divide and conquer ---------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix by QR-based dynamically weighted Halley steps."""
    m = len(a)
    eye = np.eye(m)
    scale = np.linalg.norm(a)
    if scale == 0:
        return eye
    x, low = a / scale, 1e-16 / np.sqrt(m)  # low: bound on the least singular value of x
    for _ in range(40):
        gap = (4 * (1 - low ** 2) / low ** 4) ** (1 / 3) if low < 1 else 0.0
        root = np.sqrt(1 + gap)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * gap + 8 * (2 - low ** 2) / (low ** 2 * root), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        nxt = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        nxt = (nxt + nxt.T) / 2
        moved = np.linalg.norm(nxt - x)
        x = nxt
        low = min(1.0, low * (wa + wb * low ** 2) / (1 + wc * low ** 2))
        if moved < 1e-9 and abs(1 - low) < 1e-12:  # cubic: the next step would change nothing
            break
    return x


def split_subspace(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift inside the spectrum; None if
    all eigenvalues agree to rounding."""
    m = len(a)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m))
    if spread <= 1e-15 * m * max(np.linalg.norm(a), 1e-300):
        return None
    # the mean of the spectrum lies strictly inside it; a median of the diagonal splits more evenly
    for shift in (np.median(np.diag(a)), mean, mean + 0.1 * spread / m, mean - 0.1 * spread / m):
        p = (np.eye(m) + polar_factor(a - shift * np.eye(m))) / 2
        k = int(round(np.trace(p)))
        if not 0 < k < m or np.linalg.norm(p @ p - p) > 1e-8:
            continue
        rng = np.random.default_rng(m)
        q = np.linalg.qr(p @ rng.standard_normal((m, k)))[0]
        q = np.linalg.qr(p @ q)[0]
        rest = (np.eye(m) - p) @ rng.standard_normal((m, m - k))
        rest = np.linalg.qr(rest - q @ (q.T @ rest))[0]
        rest = np.linalg.qr((np.eye(m) - p) @ rest - q @ (q.T @ rest))[0]
        return q, rest
    return None


def leading_components(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, columns of unit eigenvectors) of the ``count`` largest eigenvalues, falling."""
    found: list[tuple[float, np.ndarray]] = []
    todo = [np.eye(len(v))]  # bases of subspaces, the one with the largest eigenvalues last
    while todo and len(found) < count:
        basis = todo.pop()
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        parts = split_subspace(a) if len(a) > 1 else None
        if parts is None:
            found += [(float(x @ v @ x), x) for x in basis.T]
        else:
            todo += [basis @ parts[1], basis @ parts[0]]
    found = sorted(found, key=lambda x: -x[0])[:count]
    vectors, _ = np.linalg.qr(np.stack([x for _, x in found], axis=1))
    values = np.einsum("ij,ik,kj->j", vectors, v, vectors)
    return np.maximum(values, 0.0), vectors


# --- rows as packed grid vectors -----------------------------------------------------

def pack(x: np.ndarray) -> list[bytes]:
    """Rows of int64 as a width byte and little-endian integers of the least width that holds the row."""
    top = np.maximum(x.max(1), -1 - x.min(1)) if x.shape[1] else np.zeros(len(x), np.int64)
    out: list[bytes] = [b""] * len(x)
    widths = np.where(top < 1 << 15, 2, np.where(top < 1 << 31, 4, 8))
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        raw = np.ascontiguousarray(x[rows].astype(f"<i{width}"))
        for i, r in zip(rows.tolist(), raw):
            out[i] = bytes([width]) + r.tobytes()
    return out


def unpack(column, d: int) -> np.ndarray:
    """int64 matrix of packed rows."""
    rows = column.to_pylist()
    x = np.empty((len(rows), d), np.int64)
    widths = np.fromiter((r[0] for r in rows), np.int64, len(rows))
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        raw = np.frombuffer(b"".join([rows[i] for i in at.tolist()]), np.uint8).reshape(len(at), 1 + width * d)
        x[at] = np.ascontiguousarray(raw[:, 1:]).view(f"<i{width}").astype(np.int64)
    return x


def batches_of(batches, column: int, d: int):
    """(record batch, its matrix) in parts of at most ``BATCH`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            yield part, unpack(part.column(column), d)


def grid_rows(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, d, x) of the usable rows."""
    kind = embeddings.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                ids, lists = part.column(0), part.column(1)
                flat = lists.flatten()
                sizes = np.diff(lists.offsets.to_numpy()) if not lists.null_count else np.fromiter(
                    (len(v) if v is not None else 0 for v in lists.to_pylist()), np.int64, len(lists))
                owner = np.repeat(np.arange(len(lists)), sizes)
                c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: nan
                good = sizes > 0
                good[owner[~np.isfinite(c)]] = False
                ends = np.cumsum(sizes)
                for d in np.unique(sizes[good]).tolist():
                    rows = np.flatnonzero(good & (sizes == d))
                    values = c[(ends[rows] - d)[:, None] + np.arange(d)]
                    with np.errstate(over="ignore"):
                        x = np.clip(np.floor(GRID * values), -SATURATE, SATURATE).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows)), pa.array(np.full(len(rows), d, np.int32)), pa.array(pack(x), pa.binary())],
                        ["id", "d", "x"])
    source = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    return map_arrow(source, run, f"id {kind}, d int, x binary")


# --- moments over the fit list ----------------------------------------------------------

def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension; d rows come to the driver."""
    def run(batches):
        n, total = 0, [0] * d
        for _, x in batches_of(batches, 0, d):
            n += len(x)
            if np.abs(x).max() < 1 << 40:
                sums = x.sum(0).tolist()
            else:
                sums = [sum(col) for col in x.T.tolist()]
            total = [a + b for a, b in zip(total, sums)]
        if n:
            yield pa.RecordBatch.from_arrays(  # two halves: a task's sum can exceed a long
                [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([t >> 32 for t in total], pa.int64()),
                 pa.array([t & 0xFFFFFFFF for t in total], pa.int64())], ["i", "n", "hi", "lo"])
    rows = map_arrow(fit.select("x"), run, "i int, n long, hi long, lo long").groupBy("i").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("hi", "lo")]).collect()
    sums = {r["i"]: (int(r["hi"]) << 32) + int(r["lo"]) for r in rows}
    return (rows[0]["n"], [sums[i] for i in range(d)]) if rows else (0, [])


def product_sums(fit: DataFrame, mean: np.ndarray, projection: np.ndarray | None = None) -> np.ndarray:
    """Sum of y y^T over the fit list, y = (x - mean), projected if asked; one matrix a task, summed by cell."""
    d = len(mean)
    m = d if projection is None else projection.shape[1]
    upper = np.triu_indices(m)

    def run(batches):
        total = None
        for _, x in batches_of(batches, 0, d):
            y = x - mean
            if projection is not None:
                y = y @ projection
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(upper[0] * m + upper[1], pa.int64()), pa.array(total[upper])], ["cell", "v"])
    out = np.zeros(m * m)
    for r in map_arrow(fit.select("x"), run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        out[r["cell"]] = r["v"]
    out = out.reshape(m, m)
    return np.triu(out) + np.triu(out, 1).T


class Model(NamedTuple):
    n: int
    sums: list[int]
    mean: np.ndarray         # S / n
    projection: np.ndarray   # component columns over sqrt(e); 0 where e is 0
    varies: list[bool]       # whether a component has variance
    explained: list[float | None]
    identity_error: float | None


def fit_model(fit: DataFrame, d: int, components: int = COMPONENTS) -> Model | None:
    n, sums = exact_sums(fit, d)
    if not n:
        return None
    mean = np.array([float(Fraction(s, n)) for s in sums])
    v = product_sums(fit, mean) / n
    trace = float(np.trace(v))
    e, vectors = leading_components(v, min(components, d))
    varies = e > 1e-13 * trace
    projection = np.where(varies, vectors / np.sqrt(np.where(varies, e, 1.0)), 0.0)
    explained = [float(x) / trace if trace > 0 else None for x in np.where(varies, e, 0.0)]
    error = None
    if varies.any():
        z = product_sums(fit, mean, projection[:, varies]) / n
        error = float(np.abs(z - np.eye(len(z))).max())
    return Model(n, sums, mean, projection, varies.tolist(), explained, error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None where it exceeds a long."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        return (np.square(n * x - np.array(sums, np.int64))).sum(1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error; a row per vector and component."""
    spark = embeddings.sparkSession
    rows = materialize(grid_rows(embeddings, id_col, vector_col), "whitening-rows")
    kind = rows.schema["id"].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    usual = rows.groupBy("d").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    if usual is None:
        return spark.createDataFrame([], schema)
    d = usual["d"]
    rows = rows.filter(F.col("d") == d)
    fit = materialize(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).select("x"), "whitening-fit")
    model = spark.sparkContext.broadcast(fit_model(fit, d, components))
    k = len(model.value.varies)

    def run(batches):
        m = model.value
        for batch, x in batches_of(batches, 1, d):
            z = (x - m.mean) @ m.projection
            at = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(at), m.n)), pa.array(deviations(x, m.n, m.sums), pa.int64()).take(pa.array(at)),
                 pa.array(z.ravel(), mask=np.tile(~np.array(m.varies), len(x))),
                 pa.array(m.explained * len(x), pa.float64()), pa.array([m.identity_error] * len(at), pa.float64())],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return map_arrow(rows.select("id", "x"), run, schema)
