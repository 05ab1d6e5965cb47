"""Embedding whitening: principal components by contour integration (FEAST).

Vectors are brought to integers (``floor(256 * c)``), so that the sums over the
fit list (each distinct vector once) are exact whatever the partitioning: every
task sums the products of its rows, exactly, and sends them on as limbs of 32
bits, which Spark adds.  Only ``d (d + 3) / 2`` sums come to the driver, where d
is the vectors' length; they grow with the dimension, never with the rows.

The covariance's largest eigenvalues are then sought in intervals.  Inertia
counts (the signs of the pivots of a symmetric factorisation of ``V - s I``) say
how many eigenvalues lie below any ``s``; with them the upper end of the
spectrum is cut into intervals of few eigenvalues.  In each, the quadrature of
``(z I - V)^-1 Y`` along a circle round the interval projects Y onto its
eigenvectors, and a Rayleigh-Ritz step extracts them; this is repeated until
the residuals are at rounding and as many pairs are found as the inertia says,
so that none is missed.  A last Rayleigh-Ritz step over all intervals makes the
components orthogonal.

Defined results: rows whose vector is null or empty or holds a null or a
non-finite entry are dropped; so are none else.  Shorter vectors count as filled
up with zeros to the longest.  A scaled entry beyond a long counts as the
nearest long; a deviation beyond a long is null.  Rows that repeat an id stay
rows; copies enter the fit list once.  Components of which the eigenvalue is
zero (to rounding) have no whitened value and are left out, so a table of one
distinct vector, or an empty one, gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchpulse.llm.tables import ship_package, written

SCALE = 256
#: Eigenvalues in an interval, nodes of its half circle, repetitions.
PER_INTERVAL, NODES, REPEATS = 8, 12, 40
#: Rows of which products are summed at a time.
CHUNK_ROWS = 4096
_LONG = 2**63


def scaled(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and the integers of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # floor() of a double beyond a long stops at the long's end
    x = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-9.3e18)), F.lit(9.3e18))) + F.lit(0).cast("long"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"), whole.alias("whole"))
    return rows.where("whole and size(v) > 0").select("vec_id", x.alias("x"))


def filled(rows: DataFrame, dim: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") < dim, F.concat("x", zeros)).otherwise(F.col("x")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def _exact_products(x: np.ndarray) -> np.ndarray:
    """``x^T x`` of an integer matrix without rounding."""
    top = int(np.abs(x.astype(float)).max(initial=0)) + 1
    if len(x) * top * top < 2**53:
        y = x.astype(float)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T.dot(y)


def _limbs(values) -> list[pa.Array]:
    """Whole numbers in limbs of 32 bits, the last with the sign."""
    mask, columns = (1 << 32) - 1, []
    for k in range(4):
        columns.append(pa.array([int(v) >> 96 if k == 3 else (int(v) >> (32 * k)) & mask for v in values], pa.int64()))
    return columns


def _sums(dim: int):
    """Each task's sums of entries (j = -1) and of products."""
    def add(batches):
        products, sums = np.zeros((dim, dim), object), np.zeros(dim, object)
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            for at in range(0, len(x), CHUNK_ROWS):
                part = x[at : at + CHUNK_ROWS]
                products += _exact_products(part)
                sums += part.astype(object).sum(axis=0)
        i, j = np.triu_indices(dim)
        a, b = np.append(i, np.arange(dim)), np.append(j, np.full(dim, -1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), *_limbs([*products[i, j], *sums])], names=["i", "j", "l0", "l1", "l2", "l3"]
        )

    return add


def covariance(fit: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, sums S, and the covariance, each entry rounded once."""
    n = fit.count()
    parts = fit.mapInArrow(_sums(dim), "i int, j int, l0 long, l1 long, l2 long, l3 long").groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(4)])
    sums, products = [0] * dim, np.zeros((dim, dim), object)
    for r in parts.collect():
        value = sum(r[f"l{k}"] << (32 * k) for k in range(4))
        if r["j"] < 0:
            sums[r["i"]] = value
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = value
    cov = np.zeros((dim, dim))
    for i in range(dim):
        for j in range(dim if n else 0):
            cov[i, j] = (n * products[i, j] - sums[i] * sums[j]) / (n * n)
    return n, sums, cov


def below(v: np.ndarray, s: float) -> int:
    """How many eigenvalues of the symmetric ``v`` are less than ``s``: the
    negative ones of the pivots of ``v - s I``, of one or two rows, the largest
    taken first."""
    a, negative = v - s * np.eye(len(v)), 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(np.triu(a, 1))
        r, c = divmod(int(off.argmax()), len(a))
        if not max(diagonal[p], off[r, c]):
            break
        two = diagonal[p] < 0.6404 * off[r, c]  # (1 + sqrt(17)) / 8: least growth
        pivot = [r, c] if two else [p]
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block, side = a[np.ix_(pivot, pivot)], a[np.ix_(rest, pivot)]
        negative += 1 if two else int(block[0, 0] < 0)  # a block of two rows has one eigenvalue of each sign
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return negative


def intervals(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues in it) that hold the ``k`` largest
    eigenvalues above rounding, highest first."""
    d = len(v)
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    least = top * d * 1e-14
    if not top or below(v, least) == d:
        return []
    want, low, high = min(k, d - below(v, least)), least, top
    # the highest cut that still has `want` eigenvalues above it
    for _ in range(60):
        middle = math.sqrt(low * high)
        if d - below(v, middle) >= want:
            low = middle
        else:
            high = middle
        if high / low < 1.02:
            break
    todo, out = [(low, top, d - below(v, low))], []
    while todo:
        a, b, n = todo.pop()
        if n == 0:
            continue
        if (n > PER_INTERVAL or b > 3 * a) and b > a * (1 + 1e-10):
            middle = math.sqrt(a * b)
            over = below(v, b) - below(v, middle)
            todo += [(a, middle, n - over), (middle, b, over)]
        else:
            out.append((a, b, n))
    return out


def feast(v: np.ndarray, a: float, b: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` eigenpairs of ``v`` in the interval."""
    d, size = len(v), float(np.abs(v).sum(axis=1).max())
    centre, radius = (a + b) / 2, (b - a) / 2 * (1 + 1e-7) + 1e-14 * size
    width, nodes = min(d, 2 * n + 6), NODES
    y = np.random.default_rng(1).standard_normal((d, width))
    for repeat in range(REPEATS):
        at, weight = np.polynomial.legendre.leggauss(nodes)
        q = np.zeros((d, y.shape[1]))
        for t, w in zip(at, weight):
            turn = np.exp(1j * math.pi / 2 * (1 - t))
            q += w / 2 * (radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(d) - v, y.astype(complex))).real
        # an orthonormal basis of what the projection left, without directions of mere rounding
        left, weight_of, _ = np.linalg.svd(q, full_matrices=False)
        basis = left[:, weight_of > 1e-13 * weight_of[0]]
        e, turned = np.linalg.eigh(basis.T @ v @ basis)
        x = basis @ turned
        inside = (e > centre - radius) & (e < centre + radius)
        off = np.linalg.norm(v @ x - x * e, axis=0)
        good = inside & (off <= 4e-15 * size * math.sqrt(d))
        if good.sum() == n and (inside.sum() == n or repeat > 3):
            return e[good], x[:, good]
        y = x if x.shape[1] >= n else np.hstack([x, np.random.default_rng(repeat + 2).standard_normal((d, width - x.shape[1]))])
        if repeat % 8 == 7:
            nodes += NODES
            width = min(d, 2 * width)
            y = np.hstack([x, np.random.default_rng(repeat + 2).standard_normal((d, max(0, width - x.shape[1])))])
    raise ArithmeticError(f"{n} eigenvalues lie in [{a}, {b}]; the contour found others")


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above rounding, falling, and their unit
    eigenvectors in columns."""
    parts = [feast(v, *i) for i in intervals(v, k)]
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    basis, _ = np.linalg.qr(np.hstack([x for _, x in parts]))
    e, turned = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-e)[:k]
    return e[order], (basis @ turned)[:, order]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S`` exactly, as longs where they hold it."""
    top = n * (int(np.abs(x.astype(float)).max(initial=0)) + 1) + max(map(abs, sums))
    if top * top * x.shape[1] < _LONG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _moments(n: int, sums: list[int], turn: np.ndarray):
    """Each task's sums of products of whitened values."""
    def add(batches):
        k = turn.shape[1]
        total = np.zeros((k, k))
        for batch in batches:
            x = _matrix(batch.column("x"), turn.shape[0])
            w = (_centred(x, n, sums).astype(float) / n) @ turn
            total += w.T @ w
        i, j = np.indices((k, k))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    return add


def _project(n: int, sums: list[int], turn: np.ndarray, explained: np.ndarray, error: float):
    def project(batches):
        k = turn.shape[1]
        for batch in batches:
            x = _matrix(batch.column("x"), turn.shape[0])
            z = _centred(x, n, sums)
            square = (z * z).sum(axis=1)
            deviation = [int(s) if s < _LONG else None for s in square]
            w = (z.astype(float) / n) @ turn
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(x) * k, n), pa.int64()),
                 pa.array([deviation[i] for i in each], pa.int64()), pa.array(w.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return project


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, k: int = 4) -> DataFrame:
    """Whitened values of every usable row on the first ``k`` components."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = scaled(vectors)
    dim = rows.agg(F.max(F.size("x"))).first()[0]
    if dim is None:
        return spark.createDataFrame([], OUT)
    rows = filled(rows, dim)
    # copies meet before the shuffle, so a vector that fills a third of the table is one row of each task
    fit = written(rows.select("x").distinct(), "fit")
    n, sums, cov = covariance(fit, dim)
    e, axes = components(cov, k)
    if not len(e):
        return spark.createDataFrame([], OUT)
    turn, explained = axes / np.sqrt(e), e / np.trace(cov)
    of = fit.mapInArrow(_moments(n, sums, turn), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    error = max(abs(r["s"] / n - (r["i"] == r["j"])) for r in of.collect())
    return rows.mapInArrow(_project(n, sums, turn, explained, error), OUT)
