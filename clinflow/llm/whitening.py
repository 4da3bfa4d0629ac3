"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of a table of vectors, without ever forming V: a block of
trial vectors Q is multiplied by V in passes over the table, each the sum of Xᵀ(XQ) over centred rows X.
A Chebyshev polynomial of V, whose three-term recurrence takes one pass per degree, damps the part of the
spectrum below the block and lets the rest grow; then QR, and a Rayleigh-Ritz step on the block. That is
repeated until the residuals of the wanted vectors certify them. The interval that is damped ends at the
block's least Ritz value; where it begins comes from a Lanczos vector that rides along in the first passes.

The driver holds sums whose size depends on the dimension alone; what the tasks add up is summed entry by
entry in a shuffle, not on the driver. The vectors are stored once, as the whole numbers that all passes
read.

Rows: dropped are rows whose vector is NULL, empty, or holds a NULL, a non-finite entry or one of 2**40 and
more (whose scaled value no double holds exactly with its neighbours), and rows whose vector has another
length than most have (the longer of two equally frequent ones counts). Repeated rows, and rows with a
repeated or NULL vec_id, count and come back each for itself. Directions without variance (one row, equal
rows, fewer rows than dimensions) cannot be whitened and have no component. Empty tables give no rows.
Equal eigenvalues: any orthonormal vectors of their space, the same for all rows. Only the id and
the vector are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.operators.storage import materialize

SCALE, SHIFT = 1024, 100_000
#: Entries must stay below this.
LARGEST = float(1 << 40)


@dataclass(frozen=True)
class Whitening:
    """Fitted model: ``n`` vectors with exact sums, trace of V, eigenvalues falling, unit vectors as columns."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    passes: int
    residual: float

    @property
    def mean(self) -> np.ndarray:
        return _mean(self.n, self.sums)

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _mean(n: int, sums: tuple[int, ...]) -> np.ndarray:
    return np.array([s / n for s in sums])


def _rows(batch: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def scaled(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, x): the usable rows with their vectors as whole numbers, stored."""
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    usable = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall(
        "v", lambda c: F.coalesce((c < F.lit(LARGEST)) & (c > F.lit(-LARGEST)), F.lit(False)))
    whole = F.transform("v", lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT)
    kept = materialize(rows.where(usable).select("vec_id", whole.alias("x")), "vectors")
    lengths = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).take(2)
    if len(lengths) < 2:
        return kept
    return materialize(kept.where(F.size("x") == lengths[0]["d"]), "vectors")


def _sum(rows: DataFrame, partial: Callable[[Iterator[np.ndarray]], np.ndarray], d: int) -> np.ndarray:
    """The sum over all tasks of what ``partial`` makes of a task's vectors."""
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = partial(_rows(b, "x", d) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total)], ["entry", "value"])

    found = rows.select("x").mapInArrow(one, "entry int, value double")
    return np.array([r[1] for r in sorted(
        found.groupBy("entry").agg(F.sum("value")).collect())])


def totals(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and their exact sum; halves of the numbers are added apart, so that no sum
    leaves the range of a long."""
    low = (1 << 26) - 1
    entry = F.col("c")
    found = rows.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.count("*").alias("n"), F.sum(F.shiftright(entry, 26)).alias("high"),
        F.sum(entry.bitwiseAND(F.lit(low))).alias("low")).collect()
    sums = tuple((r["high"] << 26) + r["low"] for r in sorted(found))
    return (found[0]["n"] if found else 0), sums


class _Passes:
    """Products of the centred covariance with blocks of vectors, one job each."""

    def __init__(self, rows: DataFrame, n: int, sums: tuple[int, ...]):
        self.rows, self.n, self.mean, self.count = rows, n, _mean(n, sums), 0

    def trace(self) -> float:
        mean, d = self.mean, self.mean.size

        def partial(blocks: Iterator[np.ndarray]) -> np.ndarray:
            return sum((((b - mean) ** 2).sum(axis=0) for b in blocks), np.zeros(d))

        return float(_sum(self.rows, partial, d).sum() / self.n)

    def times(self, block: np.ndarray) -> np.ndarray:
        """V times the block."""
        self.count += 1
        mean, d = self.mean, self.mean.size

        def partial(blocks: Iterator[np.ndarray]) -> np.ndarray:
            total = np.zeros(block.shape)
            for b in blocks:
                centred = b - mean
                total += centred.T @ (centred @ block)
            return total.reshape(-1)

        return _sum(self.rows, partial, d).reshape(block.shape) / self.n


class _LowerEnd:
    """Lanczos steps, one in each of the first passes: a lower bound of the spectrum."""

    def __init__(self, d: int, rng: np.random.Generator):
        v = rng.standard_normal(d)
        self.basis, self.alpha, self.beta = [v / np.linalg.norm(v)], [], []

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def step(self, product: np.ndarray) -> None:
        self.alpha.append(float(self.vector @ product))
        rest = product - sum(((b @ product) * b for b in self.basis), np.zeros(product.size))
        rest -= sum(((b @ rest) * b for b in self.basis), np.zeros(product.size))
        norm = float(np.linalg.norm(rest))
        self.beta.append(norm)
        self.basis.append(rest / norm if norm > 0 else rest)

    def bound(self) -> float:
        if not self.alpha:
            return 0.0
        tri = np.diag(self.alpha) + np.diag(self.beta[:-1], 1) + np.diag(self.beta[:-1], -1)
        return max(0.0, float(np.linalg.eigvalsh(tri)[0]) - self.beta[-1])


def _ritz(q: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, their vectors and V times these."""
    small = q.T @ product
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, product @ turn


def _growth(t: float) -> float:
    """By how much the polynomial grows at t per degree."""
    return t + np.sqrt(max(t * t - 1, 0.0))


def fit(
    rows: DataFrame, components: int = 8, guard: int = 24, degree: int = 8,
    tolerance: float = 2e-14, max_rounds: int = 60, seed: int = 7,
) -> Whitening | None:
    """Leading ``components`` eigenpairs of the covariance of ``scaled`` rows; None without rows.

    The block holds ``guard`` vectors more. Certified are vectors whose residual is at most
    ``tolerance`` times the largest eigenvalue, or cannot fall any further because rounding of the sums
    holds it, which must be below 1e-11; else this raises.
    """
    n, sums = totals(rows)
    if not n:
        return None
    d = len(sums)
    passes = _Passes(rows, n, sums)
    trace = passes.trace()
    k, width = min(components, d), min(components + guard, d)
    rng = np.random.default_rng(seed)
    empty = Whitening(n, sums, trace, np.empty(0), np.empty((d, 0)), 0, 0.0)
    # Rounding of the mean leaves equal rows with a variance of about the square of its last bit.
    if trace <= d * (np.abs(passes.mean).max() * 2.0 ** -50) ** 2:
        return empty
    lower = _LowerEnd(d, rng)
    q, _ = np.linalg.qr(rng.standard_normal((d, width)))
    before = np.inf
    for turn in range(max_rounds):
        values, q, product = _ritz(q, passes.times(q))
        k = min(k, int((values > values[0] * 1e-12).sum()))
        residual = float(np.linalg.norm(product[:, :k] - q[:, :k] * values[:k], axis=0).max())
        small = residual / values[0]
        if small <= tolerance or width == d or (small <= 1e-11 and residual > before / 2):
            return Whitening(n, sums, trace, values[:k], q[:, :k], passes.count, small)
        before = residual
        # Damp [low, high]: mapped to [-1, 1], where the polynomial stays within 1. Scaling by its value
        # at the largest eigenvalue keeps the recurrence in range.
        high, low = values[-1], min(lower.bound(), 0.99 * values[-1])
        centre, half = (high + low) / 2, max((high - low) / 2, 1e-300)
        sigma = half / (values[0] - centre) if values[0] > centre else 1.0
        first = sigma
        old, new = q, (product - centre * q) * (sigma / half)
        # The largest eigenvalue must not outgrow the least wanted one by so much that rounding takes the
        # place of the latter's vector: steep spectra get lower degrees, which are enough for them.
        spread = np.log(_growth((values[0] - centre) / half) / _growth((values[k - 1] - centre) / half))
        steps = degree if spread <= 0 else int(np.clip(np.log(1e6) / spread, 1, degree))
        for _ in range(steps - 1):
            block = new if turn else np.column_stack([new, lower.vector])
            product = passes.times(block)
            if not turn:
                lower.step(product[:, -1])
                product = product[:, :-1]
            following = 1.0 / (2.0 / first - sigma)
            old, new = new, (product - centre * new) * (2.0 * following / half) - old * (
                sigma * following)
            sigma = following
        q, _ = np.linalg.qr(new)
    raise RuntimeError(f"no convergence in {passes.count} passes: residual {small}")


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    mean, turn = model.mean, model.projection
    d, k = turn.shape
    if not k:
        return 0.0

    def partial(blocks: Iterator[np.ndarray]) -> np.ndarray:
        total = np.zeros(k + k * k)
        for b in blocks:
            w = (b - mean) @ turn
            total += np.concatenate([w.sum(axis=0), (w.T @ w).reshape(-1)])
        return total

    total = _sum(rows, partial, d) / model.n
    centre = total[:k]
    return float(np.abs(total[k:].reshape(k, k) - np.outer(centre, centre) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact squared length of n*x - S per row; None where it leaves the range of a long."""
    reach = max(max(abs(n * int(x[:, i].max()) - s), abs(n * int(x[:, i].min()) - s))
                for i, s in enumerate(sums))
    if reach * reach * len(sums) < 1 << 62 and n * int(np.abs(x).max()) < 1 << 62:
        off = n * x - np.array(sums, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    found = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in found]


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, whitened array, deviation) of ``scaled`` rows."""
    mean, turn, n, sums = model.mean, model.projection, model.n, model.sums
    d, k = turn.shape
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch, "x", d)
                ends = np.arange(0, (batch.num_rows + 1) * k, k, dtype=np.int32) if k else np.zeros(
                    batch.num_rows + 1, np.int32)
                white = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(((x - mean) @ turn).reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), white, pa.array(deviations(x, n, sums), pa.int64())],
                    ["vec_id", "whitened", "deviation"])

    return rows.select("vec_id", "x").mapInArrow(
        run, f"vec_id {kind}, whitened array<double>, deviation bigint")


def whiten(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = 8) -> DataFrame:
    """One row per usable vector and component: n, deviation, whitened, explained, identity_error."""
    rows = scaled(table, vector, vec_id)
    model = fit(rows, components)
    if model is None:
        model = Whitening(0, (), 0.0, np.empty(0), np.empty((0, 0)), 0, 0.0)
        error = 0.0
    else:
        error = identity_error(rows, model)
    shares = [float(v / model.trace) for v in model.values] or [0.0]
    done = transform(rows, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return done.select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(F.lit(shares), F.col("i") + 1).alias("explained"),
        F.lit(error).alias("identity_error"))
