"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V come from products of V with a block of vectors only. Each product is one
pass over the centred rows X, spread over the cluster: every task returns its share of X^T (X Q), d x k numbers, and
the shares are added up in Spark. A filter is a Chebyshev polynomial in V, applied by its three-term recurrence, which
stays small on the unwanted part of the spectrum and grows steeply above it. After each filter the block is made
orthonormal (QR) and rotated to Ritz vectors (Rayleigh-Ritz). Ritz pairs whose residual |V q - e q| is at rounding
level are locked and kept out of later filters; the iteration ends when all wanted pairs are certified that way.

One more column of the block runs Lanczos steps from a random start. Its tridiagonal matrix tells where the spectrum
begins, which narrows the interval that the filter damps; an estimate too high slows the filter and changes no result.

Only d x k numbers travel to the driver in a pass, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import common, vectors

SCALE, SHIFT = 1024.0, 100_000
#: Scaled entries are held within this, far beyond any embedding, so that whole-number sums stay exact.
LIMIT = 1 << 40
COMPONENTS = 8
#: Vectors in the block beyond the wanted ones; a wider block needs fewer passes.
GUARD = 24
#: Most steps of one filter, and the largest growth it may give the block's leading direction over the damped part.
DEGREE, GROWTH = 12, 1e9
#: A pair is certified when its residual is below this share of the largest eigenvalue.
RESIDUAL = 2e-14
#: Outer rounds without a residual halved after which rounding, not the filter, is what is left.
PATIENCE, ROUNDS = 3, 200
#: Eigenvalues below this share of the trace are zero: such directions cannot be scaled to variance 1.
ZERO = 1e-12


@dataclass
class Whitening:
    """Count, exact sums per dimension, and the leading eigenpairs of the covariance; ``residual`` certifies each."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    basis: np.ndarray  # d x components
    residual: np.ndarray
    passes: int

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole part and remainder over n, so that entries can be centred without rounding."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([s - self.n * w for s, w in zip(self.sums, whole, strict=True)], np.int64)


def centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    """x - S/n in double precision: the difference to the whole part is exact."""
    return (x - whole).astype(np.float64) - rest / n


def _cells(rows: DataFrame, share, kind: str) -> dict[int, object]:
    """Sums by cell of what ``share(matrices)`` returns for each task's rows: (cell numbers, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = share(batch.column("x"))
                total = part if total is None else total + part
        if total is not None:
            values = pa.array(total.ravel().tolist(), pa.decimal128(38, 0)) if kind != "double" else pa.array(total.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), values], names=["cell", "value"])

    parts = rows.select("x").mapInArrow(run, f"cell bigint, value {kind}")
    found = parts.groupBy("cell").agg(F.sum("value").cast(kind).alias("value")).collect()
    return {r["cell"]: r["value"] for r in found}


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and whole-number sums per dimension."""

    def share(column: pa.Array) -> np.ndarray:
        x = vectors.matrix(column, d)
        sums = [len(x), *(int(s) for s in x.sum(axis=0))]
        return np.array(sums, object)

    found = _cells(rows, share, "decimal(38,0)")
    return int(found.get(0, 0)), [int(found.get(j + 1, 0)) for j in range(d)]


class Covariance:
    """V as an operator: ``times`` gives V Q for any block Q by one distributed pass."""

    def __init__(self, rows: DataFrame, d: int, n: int, whole: np.ndarray, rest: np.ndarray) -> None:
        self.rows, self.d, self.n, self.whole, self.rest = rows, d, n, whole, rest
        self.passes = 0

    def trace(self) -> float:
        d, n, whole, rest = self.d, self.n, self.whole, self.rest

        def share(column: pa.Array) -> np.ndarray:
            return np.square(centred(vectors.matrix(column, d), whole, rest, n)).sum(axis=0)

        return math.fsum(_cells(self.rows, share, "double").values()) / n

    def times(self, q: np.ndarray) -> np.ndarray:
        d, n, whole, rest = self.d, self.n, self.whole, self.rest
        self.passes += 1

        def share(column: pa.Array) -> np.ndarray:
            x = centred(vectors.matrix(column, d), whole, rest, n)
            return x.T @ (x @ q)

        found = _cells(self.rows, share, "double")
        return np.array([found[i] for i in range(q.size)]).reshape(q.shape) / n


class Lanczos:
    """Steps of one random vector, orthogonal to all before; ``floor`` estimates the lower end of the spectrum."""

    def __init__(self, d: int) -> None:
        start = np.random.default_rng(d).normal(size=d)
        self.kept = [start / np.linalg.norm(start)]
        self.diagonal: list[float] = []
        self.beside: list[float] = []

    @property
    def vector(self) -> np.ndarray:
        return self.kept[-1] if len(self.kept) > len(self.diagonal) else np.zeros_like(self.kept[0])

    def step(self, product: np.ndarray) -> None:
        if len(self.kept) == len(self.diagonal):
            return
        last = self.kept[-1]
        self.diagonal.append(float(last @ product))
        base = np.array(self.kept).T
        left = product - base @ (base.T @ product)
        left -= base @ (base.T @ left)
        size = float(np.linalg.norm(left))
        self.beside.append(size)
        if len(self.kept) < len(last) and size > 1e-9 * max(self.diagonal):
            self.kept.append(left / size)

    def floor(self) -> float:
        m = len(self.diagonal)
        if m < 3:
            return 0.0
        off = self.beside[: m - 1]
        value, vector = np.linalg.eigh(np.diag(self.diagonal) + np.diag(off, 1) + np.diag(off, -1))
        return max(0.0, float(value[0] - self.beside[m - 1] * abs(vector[-1, 0])))


def _degree(low: float, high: float, top: float) -> int:
    """Steps after which the leading direction has outgrown the damped interval by ``GROWTH``."""
    at = (2 * top - high - low) / (high - low)
    return int(min(DEGREE, max(2, math.log(GROWTH) / math.acosh(at)))) if at > 1 + 1e-9 else DEGREE


def leading(cov: Covariance, wanted: int, guard: int = GUARD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling), their unit vectors and certified residuals."""
    d = cov.d
    k = min(d, wanted + guard)
    probe = Lanczos(d)
    q = np.linalg.qr(np.random.default_rng([d, k]).normal(size=(d, k)))[0]
    locked, locked_values, locked_residual = np.empty((d, 0)), np.empty(0), np.empty(0)
    best, stale = np.inf, 0

    def product(block: np.ndarray) -> np.ndarray:
        both = cov.times(np.column_stack([block, probe.vector]))
        probe.step(both[:, -1])
        return both[:, :-1]

    def apart(block: np.ndarray) -> np.ndarray:
        return block - locked @ (locked.T @ block)

    for _ in range(ROUNDS):
        w = product(q)
        small = q.T @ w
        value, turn = np.linalg.eigh((small + small.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        residual = np.linalg.norm(w - q * value, axis=0)
        top = max(value[0], *locked_values[:1]) if len(locked_values) else value[0]
        missing = min(wanted, d) - len(locked_values)
        worst = residual[:missing].max()
        stale = 0 if worst < best / 2 else stale + 1
        best = min(best, worst)
        done = residual[:missing] <= RESIDUAL * top
        if stale >= PATIENCE and worst <= 1e-9 * top:
            done[:] = True
        ready = missing if done.all() else int(np.argmin(done))  # lock from the top only, so that order is kept
        if ready:
            locked = np.column_stack([locked, q[:, :ready]])
            locked_values = np.append(locked_values, value[:ready])
            locked_residual = np.append(locked_residual, residual[:ready])
            q, w, value = q[:, ready:], w[:, ready:], value[ready:]
            best, stale = np.inf, 0
        if ready == missing:
            order = np.argsort(-locked_values, kind="stable")
            return locked_values[order], locked[:, order], locked_residual[order]
        low, high = probe.floor(), float(value[-1])
        if high - low <= 1e-9 * top:
            low = 0.0
        middle, half = (high + low) / 2, max((high - low) / 2, 1e-300)
        # T_m(V) q, scaled at the leading Ritz value so that nothing overflows; w = V q is known already.
        scale = half / (value[0] - middle) if value[0] > high else 1.0
        first = scale
        before, now = q, apart((w - middle * q) * (scale / half))
        for _ in range(_degree(low, high, float(value[0])) - 1):
            new_scale = 1 / (2 / first - scale)
            after = (product(now) - middle * now) * (2 * new_scale / half) - scale * new_scale * before
            before, now, scale = now, apart(after), new_scale
        now = now / np.maximum(np.linalg.norm(now, axis=0), 1e-300)
        q = np.linalg.qr(np.column_stack([locked, now]))[0][:, locked.shape[1] :]
    raise ArithmeticError("the iteration did not certify the wanted eigenpairs")


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows of ``whole_vectors``; None where no direction varies."""
    n, sums = exact_sums(rows, d)
    if n == 0:
        return None
    model = Whitening(n, sums, 0.0, np.empty(0), np.empty((d, 0)), np.empty(0), 0)
    cov = Covariance(rows, d, n, *model.centre)
    model.trace = cov.trace()
    if model.trace <= 0:
        return None
    value, basis, residual = leading(cov, components)
    real = value > ZERO * model.trace
    model.values, model.basis, model.residual, model.passes = value[real], basis[:, real], residual[real], cov.passes
    return model


def deviation(x: np.ndarray, whole: np.ndarray, rest: np.ndarray, n: int) -> list[int]:
    """sum over dimensions of (n * x - S)^2, exact: with machine numbers where they hold it, else with Python's."""
    apart = x - whole
    largest = (n * (int(np.abs(apart).max(initial=0)) + 1)) ** 2 * x.shape[1]
    kind = np.int64 if largest < 1 << 63 else object
    return np.square(n * apart.astype(kind) - rest.astype(kind)).sum(axis=1).tolist()


def whiten(rows: DataFrame, d: int, model: Whitening) -> DataFrame:
    """``vec_id``, ``deviation`` (decimal) and ``whitened`` (an array, one value a component) of every row."""
    whole, rest = model.centre
    n, scaled = model.n, model.basis / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors.matrix(batch.column("x"), d)
            white = centred(x, whole, rest, n) @ scaled
            columns = [
                batch.column("vec_id"),
                pa.array(deviation(x, whole, rest, n), pa.decimal128(38, 0)),
                pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), scaled.shape[1]).cast(pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id bigint, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, by one more pass."""
    whole, rest = model.centre
    n, scaled = model.n, model.basis / np.sqrt(model.values)
    k = scaled.shape[1]

    def share(column: pa.Array) -> np.ndarray:
        white = centred(vectors.matrix(column, d), whole, rest, n) @ scaled
        return white.T @ white

    found = _cells(rows, share, "double")
    return float(np.abs(np.array([found[i] for i in range(k * k)]).reshape(k, k) / n - np.eye(k)).max())


def whitening(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``embeddings`` (vec_id, embedding, label) and component, largest variance first.

    ``vec_id``, ``component`` (from 1), ``n`` (rows of the fit), ``deviation`` (decimal: sum over dimensions of (n*x -
    S)^2), ``whitened``, ``explained`` (share of the variance), ``residual`` (that of the eigenpair, over the largest
    eigenvalue) and ``identity_error``. x is floor(1024 * entry) + 100000, S its sum.

    Null vectors, null or non-finite entries and vectors of another than the most frequent length go. Repeated rows and
    ids count as often as they stand, rows without an id too. Directions without variance have no component, so
    constant tables, single rows and empty tables give no rows; a table of fewer varying directions has fewer
    components. Vectors of equal eigenvalues are one orthonormal choice. Other columns, ``label`` too, are not read.
    """
    rows, d = vectors.whole_vectors(embeddings.withColumn("label", F.lit(None)), SCALE, SHIFT, LIMIT)
    model = fit(rows, d, components) if d else None
    kind = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, residual double, identity_error double"
    if model is None:
        return embeddings.sparkSession.createDataFrame([], kind)
    error = identity_error(rows, d, model)
    spread = whiten(rows, d, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.element_at(common.constant_array((model.values / model.trace).tolist(), "array<double>"), F.col("at") + 1)
    left = F.element_at(common.constant_array((model.residual / model.values[0]).tolist(), "array<double>"), F.col("at") + 1)
    return spread.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share.alias("explained"),
        left.alias("residual"),
        F.lit(error).alias("identity_error"),
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings``; a deviation beyond the range of a long is null here and exact in ``whitening``."""
    found = whitening(common.table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
