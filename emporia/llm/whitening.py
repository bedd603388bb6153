"""PCA whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation (operator 11).

The rows X of centred vectors stay distributed; the driver holds what has the size of the vectors'
dimension d only.  Step j forms u = X v_j - b u_(j-1) and then X'u - a v_j in *one* pass:

* every left vector is a product of X with a short vector, u_i = X p_i, so no row keeps state: a
  task multiplies its block of rows with the p_i when it needs earlier left vectors.  A lost
  executor costs a re-read of its blocks.
* a pass returns X'u, U'u (for the full reorthogonalisation of u; X'U is known from the earlier
  passes, so the correction needs no second pass) and u'u: 2d+1 sums at most, added up by a
  map-side aggregation by index and read by the driver.
* right vectors are reorthogonalised twice against all earlier ones on the driver.

After ``steps`` passes (as many as dimensions, if not given: then the result is exact also for
repeated eigenvalues; a vector that ends a Krylov space is followed by a fresh orthogonal one) the
singular values of the small bidiagonal matrix are those of X; its right vectors, turned by the v_j,
are the components.  Sums before the decomposition (n, S) are exact integers.

Defined cases: a vector that is null, holds null, NaN or infinite entries, or an entry whose integer
form leaves the long range, is dropped; so are vectors of another length than the commonest one (the
longer of two equally common).  Components without variance (eigenvalue below 1e-24 of the trace:
nothing to divide by) give no rows, so constant data or an empty table give none.  Repeated vec_ids
are separate rows.  ``deviation`` is null where it leaves the long range (``deviation_exact`` has it
as text).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMIT = float(1 << 62)
FLAT = 1e-24
_LOW = (1 << 31) - 1


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the vectors that may take part."""
    c = F.col("embedding").cast("array<double>")
    fits = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LIMIT / SCALE))
    ok = embeddings.select("vec_id", "embedding").where(F.col("embedding").isNotNull() & F.coalesce(fits, F.lit(False)))
    lengths = ok.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    # One number to the driver: the commonest length.
    first = lengths.where(F.col("d") > 0).orderBy(F.col("n").desc(), F.col("d").desc()).limit(1).collect()
    d = first[0].d if first else 0
    whole = F.transform(c, lambda v: F.floor(v * SCALE).cast("long") + SHIFT)
    return ok.where((F.size("embedding") == d) & (F.lit(d) > 0)).select("vec_id", whole.alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            x = b.column(b.schema.get_field_index("x"))
            yield b, x.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def sums(x: DataFrame, fn: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of ``fn(block)`` (a short vector) over all blocks of rows; added in tasks, then by index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, block in _blocks(batches):
            got = fn(block)
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "v"])

    v = F.sum(F.col("v").cast("decimal(38,0)") if kind == "long" else F.col("v"))
    rows = x.select("x").mapInArrow(run, f"k long, v {kind}").groupBy("k").agg(v.alias("v")).collect()
    out = [0] * len(rows)
    for r in rows:
        out[r.k] = r.v
    return np.array([int(t) for t in out], object) if kind == "long" else np.array(out, float)


def exact_sums(x: DataFrame) -> tuple[int, list[int]]:
    """n and the per-dimension sums, exact: high and low halves are added apart in the tasks."""
    def parts(block: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(block)], (block >> 31).sum(0), (block & _LOW).sum(0)]).astype(np.int64)

    got = sums(x, parts, "long")
    if not len(got):
        return 0, []
    d = (len(got) - 1) // 2
    return int(got[0]), [(int(h) << 31) + int(lo) for h, lo in zip(got[1 : d + 1], got[d + 1 :])]


def bidiagonalise(x: DataFrame, mean: np.ndarray, steps: int | None = None, seed: int = 13) -> tuple[np.ndarray, np.ndarray, float]:
    """Right vectors V (d x k), upper bidiagonal B (k x k) with X V = U B, and the squared Frobenius norm of X."""
    d = len(mean)
    k = min(steps or d, d)
    rng = np.random.default_rng(seed)
    V, P, G = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # u_i = X p_i, g_i = X'u_i
    B = np.zeros((k, k))
    frob = float(sums(x, lambda b: np.array([np.square(b - mean).sum()]))[0])
    tiny = 1e-12 * np.sqrt(frob)

    def fresh() -> np.ndarray:
        v = rng.standard_normal(d)
        for _ in range(3):
            v -= V @ (V.T @ v)
            v /= np.linalg.norm(v)
        return v

    v, beta = fresh(), 0.0
    for j in range(k):
        V = np.column_stack([V, v])
        q = v - beta * P[:, j - 1] if beta else v

        def step(block: np.ndarray, q=q, P=P) -> np.ndarray:
            c = block - mean
            u = c @ q
            return np.concatenate([c.T @ u, (c @ P).T @ u, [u @ u]])

        got = sums(x, step)
        w, h, norm2 = got[:d], got[d : d + j], got[-1]
        w, q, norm2 = w - G @ h, q - P @ h, norm2 - h @ h
        alpha = float(np.sqrt(max(norm2, 0.0)))
        if alpha <= tiny:  # v adds no new left vector: nothing of it can be scaled
            alpha, p, g = 0.0, np.zeros(d), np.zeros(d)
        else:
            p, g = q / alpha, w / alpha
        P, G, B[j, j] = np.column_stack([P, p]), np.column_stack([G, g]), alpha
        if j + 1 == k:
            break
        r = g - alpha * v
        for _ in range(2):
            r -= V @ (V.T @ r)
        beta = float(np.linalg.norm(r))
        if beta <= tiny:  # the Krylov space is complete: go on in its complement
            v, beta = fresh(), 0.0
        else:
            v = r / beta
        B[j, j + 1] = beta
    return V, B, frob


def components(x: DataFrame, mean: np.ndarray, n: int, count: int = COMPONENTS,
               steps: int | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Unit eigenvectors (d x c) and eigenvalues of the covariance by falling eigenvalue, and its trace."""
    V, B, frob = bidiagonalise(x, mean, steps)
    if frob <= 0:
        return np.zeros((len(mean), 0)), np.zeros(0), 0.0
    _, s, rt = np.linalg.svd(B)
    keep = min(count, int((s * s > FLAT * frob).sum()))
    turned = V @ rt[:keep].T
    turned /= np.linalg.norm(turned, axis=0)
    return turned, s[:keep] ** 2 / n, frob / n


def _squares(block: np.ndarray, n: int, S: list[int]) -> list[int]:
    """Exact sum over dimensions of (n*x - S)^2 of each row: in 64 bits where they hold it, else in Python integers."""
    peak = n * max(abs(int(block.max())), abs(int(block.min()))) + max(map(abs, S))
    if peak < 1 << 62:
        t = block * np.int64(n) - np.array(S, np.int64)
        if int(np.abs(t).max()) ** 2 * len(S) < 1 << 63:
            return [int(v) for v in (t * t).sum(1)]
    return [sum((n * int(v) - s) ** 2 for v, s in zip(row, S)) for row in block]


def whitened(embeddings: DataFrame, count: int = COMPONENTS, steps: int | None = None) -> DataFrame:
    """One row per usable vector and component (see the module's text)."""
    spark = embeddings.sparkSession
    kind = dict(embeddings.dtypes)["vec_id"]
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, deviation_exact string")
    x = written(spark, integer_vectors(embeddings), "whiten-x")
    n, S = exact_sums(x)
    if not n:
        return spark.createDataFrame([], schema)
    mean = np.array([int(s) / n for s in S])
    vectors, values, trace = components(x, mean, n, count, steps)
    c = len(values)
    if not c:
        return spark.createDataFrame([], schema)
    turn = vectors / np.sqrt(values)
    explained = values / trace

    def moments(block: np.ndarray) -> np.ndarray:
        w = (block - mean) @ turn
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    got = sums(x, moments) / n
    cov = got[c:].reshape(c, c) - np.outer(got[:c], got[:c])
    error = float(np.abs(cov - np.eye(c)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in _blocks(batches):
            rows = len(block)
            w = (block - mean) @ turn
            dev = _squares(block, n, S)
            each = np.repeat(np.arange(rows), c)
            long_ = pa.array([v if v < 1 << 63 else None for v in dev], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("vec_id")).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), rows)), pa.array(np.full(rows * c, n)),
                long_.take(pa.array(each)), pa.array(w.ravel()), pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * c, error)), pa.array([str(v) for v in dev]).take(pa.array(each)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return x.mapInArrow(run, schema)
