"""Whitening of embeddings along the leading eigenvectors of their covariance.

Vectors become integers (see ``vectors``); the distinct ones are the fit list,
written once as blocks. Its size n and sums S are exact. The covariance V is
never formed: a pass over the blocks gives V Q for a block Q of vectors, each
task centring its rows, (n x - S) / n, before it multiplies, and Spark adding up
one matrix a task.

Chebyshev-filtered subspace iteration: a few Lanczos steps bound the spectrum
from below, the block's Ritz values say where the unwanted part ends, and a
Chebyshev polynomial in V, by its three-term recurrence, a pass a degree, damps
that part. QR and Rayleigh-Ritz follow; the product that Rayleigh-Ritz needs is
the first step of the next filter, so no pass is lost. It ends when the leading
pairs are certified: every residual |V q - e q| at the limit of double precision.

Defined results: of the first ``components`` eigenvalues those above 1e-12 of
the trace count, so fewer vectors than components, equal vectors or an empty
table give fewer components or none, without rows for them. Eigenvectors have
their largest entry positive. Equal rows, and rows that repeat an id, are all
projected; a null id stays null. A deviation beyond 64 bits is null. Other
columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tellerlake.llm import vectors
from tellerlake.operators.joins import written

COMPONENTS = 4
#: Vectors in the block beyond those wanted; the more, the fewer passes.
GUARD = 20
LANCZOS_STEPS = 10
#: What one filter multiplies the wanted part by against the unwanted, and the degrees for it.
GAIN, DEGREES = 1e6, (3, 24)
#: A residual against the first eigenvalue: certified below the first, or below the second if it falls no more.
CERTIFIED, SETTLED = 2e-14, 1e-11
ROUNDS = 200
SEED = 12


@dataclass
class Fit:
    """Exact size and sums of the fit list, and its leading eigenvalues and vectors (columns)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, its numerator exact where 64 bits hold it."""
    if n * int(np.abs(x).max(initial=0)) < 1 << 62 and np.abs(sums).max(initial=0) < 1 << 62:
        return (n * x - sums.astype(np.int64)) / n
    return x - np.array([int(s) // n for s in sums]) - np.array([int(s) % n / n for s in sums])


class Covariance:
    """The covariance of a written fit list as an operator on blocks of vectors."""

    def __init__(self, blocks: DataFrame, n: int, sums: list[int]):
        self.blocks, self.n, self.sums, self.passes = blocks, n, np.array(sums, object), 0

    def times(self, q: np.ndarray) -> np.ndarray:
        n, sums = self.n, self.sums
        self.passes += 1

        def fold(blocks: Iterator[np.ndarray]) -> np.ndarray:
            out = np.zeros(q.shape)
            for x in blocks:
                rows = centred(x, n, sums)
                out += rows.T @ (rows @ q)
            return out.ravel()

        return np.array(vectors.summed(self.blocks, fold, exact=False)).reshape(q.shape) / n

    def gram(self, p: np.ndarray) -> np.ndarray:
        """The covariance of the rows' projections on the columns of p."""
        n, sums = self.n, self.sums
        self.passes += 1

        def fold(blocks: Iterator[np.ndarray]) -> np.ndarray:
            out = np.zeros((p.shape[1], p.shape[1]))
            for x in blocks:
                rows = centred(x, n, sums) @ p
                out += rows.T @ rows
            return out.ravel()

        return np.array(vectors.summed(self.blocks, fold, exact=False)).reshape(p.shape[1], -1) / n


def lower_bound(v: Covariance, dimension: int, rng: np.random.Generator) -> float:
    """A value that hardly an eigenvalue is below: the smallest Ritz value of a Lanczos run less its last off-diagonal."""
    q = rng.standard_normal((dimension, 1))
    basis, diagonal, beside = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS_STEPS, dimension)):
        w = v.times(basis[-1])
        diagonal.append((basis[-1].T @ w).item())
        for _ in range(2):
            for b in basis:
                w = w - b * (b.T @ w)
        beside.append(np.linalg.norm(w))
        if beside[-1] <= 1e-12 * max(diagonal):
            break
        basis.append(w / beside[-1])
    ritz = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside[: len(diagonal) - 1], 1) + np.diag(beside[: len(diagonal) - 1], -1))
    return max(0.0, ritz[0] - beside[-1])


def degree_for(wanted: float, low: float, high: float) -> int:
    """The degree at which the Chebyshev polynomial of [low, high] is GAIN at ``wanted``."""
    beyond = 1 + 2 * (wanted - high) / max(high - low, 1e-300)
    return min(max(math.ceil(math.acosh(GAIN) / max(math.acosh(max(beyond, 1.0)), 1e-9)), DEGREES[0]), DEGREES[1])


def chebyshev(v: Covariance, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev filter of ``q``; ``vq`` is V q. Scaling by the value at ``top`` keeps it finite."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (vq - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (v.times(now) - middle * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def leading(v: Covariance, dimension: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The first eigenvalues and eigenvectors (columns) of ``v``, certified."""
    rng = np.random.default_rng(SEED)
    width = min(dimension, components + GUARD)
    wanted = min(components, dimension)
    low = lower_bound(v, dimension, rng) if width < dimension else 0.0
    q, last = np.linalg.qr(rng.standard_normal((dimension, width)))[0], math.inf
    for _ in range(ROUNDS):
        vq = v.times(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = values[0]
        worst = np.linalg.norm(vq - q * values, axis=0)[:wanted].max()
        if top <= 0 or worst <= CERTIFIED * top or (worst <= SETTLED * top and worst > last / 4):
            return values[:wanted], q[:, :wanted]
        last = worst
        high = values[-1]
        if width == dimension or high <= low or top <= high:
            # The block spans everything, or the rest has no width: plain steps of V do.
            q = np.linalg.qr(q if width == dimension else vq)[0]
            continue
        degree = degree_for(values[wanted - 1], low, high)
        q = np.linalg.qr(chebyshev(v, q, vq, low, high, top, degree))[0]
    raise ArithmeticError(f"no certified eigenvectors after {ROUNDS} rounds: residual {last:.3g} of {top:.3g}")


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Fit:
    """The whitening of ``rows`` (x), fitted to their distinct vectors."""
    # Copies fold before the shuffle; what is left is written and read by every pass.
    distinct = rows.select("x").distinct()
    blocks = written(vectors.pack(distinct, dimension), "whiten-blocks")

    def totals(found: Iterator[np.ndarray]) -> np.ndarray:
        out = np.zeros(dimension + 1, np.int64)
        for x in found:
            out[0] += len(x)
            out[1:] += x.sum(axis=0)
        return out

    n, *sums = vectors.summed(blocks, totals, exact=True) or [0]
    if not n:
        return Fit(0, [], 0.0, np.zeros(0), np.zeros((dimension, 0)), 0.0, 0)
    object_sums = np.array(sums, object)

    def spread(found: Iterator[np.ndarray]) -> np.ndarray:
        return np.array([sum(float((centred(x, n, object_sums) ** 2).sum()) for x in found)])

    trace = vectors.summed(blocks, spread, exact=False)[0] / n
    v = Covariance(blocks, n, sums)
    values, columns = leading(v, dimension, components) if trace else (np.zeros(0), np.zeros((dimension, 0)))
    use = values > 1e-12 * trace
    values, columns = values[use], columns[:, use]
    columns = columns * np.sign(columns[np.abs(columns).argmax(axis=0), np.arange(len(values))])
    error = float(np.abs(v.gram(columns / np.sqrt(values)) - np.eye(len(values))).max()) if len(values) else 0.0
    return Fit(n, sums, trace, values, columns, error, v.passes)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sums of (n x - S)^2, exact; null beyond 64 bits."""
    largest = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if x.shape[1] * largest**2 < 1 << 63:
        return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
    return [int(d) if d < 1 << 63 else None for d in exact]


def project(rows: DataFrame, dimension: int, fitted: Fit) -> DataFrame:
    """(id, n, deviation, whitened) for every row; whitened has a number a component."""
    n, sums, values, columns = fitted.n, np.array(fitted.sums, object), fitted.values, fitted.vectors
    scaled = columns / np.sqrt(values)
    schema = StructType([rows.schema["id"], *StructType.fromDDL("n bigint, deviation bigint, whitened array<double>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in vectors.in_blocks(batches, dimension):
            x = vectors.matrix(table["x"].combine_chunks(), dimension)
            whitened = (centred(x, n, sums) @ scaled).tolist()
            out = [
                table["id"].combine_chunks(),
                pa.array([n] * len(x), pa.int64()),
                pa.array(deviations(x, n, sums), pa.int64()),
                pa.array(whitened, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(out, ["id", "n", "deviation", "whitened"])

    return rows.select("id", "x").mapInArrow(run, schema)


def whiten(docs: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Fit]:
    """Every usable row's coordinates along the leading components, each of variance 1, and the fit."""
    rows, dimension = vectors.kept(docs, id, vector)
    fitted = fit(rows, dimension, components)
    return project(rows, dimension, fitted).withColumnRenamed("id", id), fitted
