"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers, ``floor(scale * c)``. The covariance is that of the distinct
vectors, added up by tasks from centred entries. Its leading eigenvalues are isolated by
counting: the signs of the pivots of LDLᵀ of ``V - s`` tell how many eigenvalues lie above
``s`` (Sylvester's law of inertia), and bisection cuts the spectrum until each slice holds
one, or equal ones. Rayleigh quotient iteration then converges cubically inside the slice,
and two more counts, just above and just below the result, certify its number.

Only the sums (one vector) and the covariance (one matrix) reach the driver.

Defined results: a vector that is null, empty, or holds null or non-finite entries is
dropped; repeated vectors count once in the fit, and each of their rows is returned; a null
id is kept; components without variance (equal vectors, fewer distinct vectors than
dimensions) are left out; equal eigenvalues are numbered in any order; an empty table gives
an empty result; vectors of different lengths, and whole numbers whose exact sums of
squares exceed a long, are errors; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from demandkit.runtime import settle

SCALE, COMPONENTS = 256, 4
#: Relative size of an eigenvalue, against the trace, that counts as no variance.
NOTHING = 1e-12
_EPS = np.finfo(float).eps
_LONG = 2.0**63


def usable(vector: Column) -> Column:
    """Not null, not empty, and all entries finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long"))


def _matrix(column: pa.Array, rows: int, kind: type = np.float64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(kind, copy=False)


def _added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``x`` of the matrices that ``part`` makes of blocks of rows.

    A task returns one matrix, row by row; matrix rows of all tasks are added in the order of
    the tasks.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = part(_matrix(batch.column("x"), batch.num_rows, np.int64))
                total = one if total is None else total + one
        if total is not None:
            task = np.full(len(total), TaskContext.get().partitionId())
            yield pa.RecordBatch.from_arrays([pa.array(task), pa.array(np.arange(len(total))), pa.array(total.tolist(), pa.list_(pa.float64()))], ["task", "i", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        sums = np.asarray(table.column("sums").to_pylist()).sum(axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    parts = rows.select("x").mapInArrow(partial, "task long, i long, sums array<double>")
    found = parts.groupBy("i").applyInArrow(add, "i long, sums array<double>").collect()
    return np.asarray([r.sums for r in sorted(found, key=lambda r: r.i)])


def _totals(fit: DataFrame) -> list[int]:
    """The exact sum of each dimension."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"), batch.num_rows, np.int64)
                safe = float(np.abs(x.astype(float)).max()) * len(x) < _LONG / 4
                sums = x.sum(axis=0).tolist() if safe else x.astype(object).sum(axis=0).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int64()), pa.array([Decimal(s) for s in sums], pa.decimal128(38))], ["i", "s"])

    found = fit.select("x").mapInArrow(partial, "i long, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return [int(r.s) for r in sorted(found, key=lambda r: r.i)]


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """How many pivots of LDLᵀ are positive, zero and negative, with diagonal pivoting.

    The largest element on or off the diagonal decides between a single pivot and a pair of
    rows, whose block has one eigenvalue of either sign (Bunch and Parlett, 1971).
    """
    a = np.array(a, dtype=float)
    bound = np.abs(a).max(initial=0) * len(a) * _EPS
    alpha = (1 + np.sqrt(17)) / 8
    plus = minus = 0
    while len(a):
        n = len(a)
        size = np.abs(a)
        i = int(size.diagonal().argmax())
        off = size - np.diag(size.diagonal())
        j, k = divmod(int(off.argmax()), n)
        if max(size[i, i], off[j, k]) <= bound:
            break
        pivots = [i] if size[i, i] >= alpha * off[j, k] else [j, k]
        rest = np.setdiff1d(np.arange(n), pivots)
        block, side = a[np.ix_(pivots, pivots)], a[np.ix_(rest, pivots)]
        if len(pivots) == 1:
            plus, minus = plus + (block[0, 0] > 0), minus + (block[0, 0] < 0)
            a = a[np.ix_(rest, rest)] - side @ side.T / block[0, 0]
        else:
            plus, minus = plus + 1, minus + 1
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return int(plus), len(a), int(minus)


class Slices:
    """Counts of eigenvalues above shifts, each computed once."""

    def __init__(self, v: np.ndarray) -> None:
        self.v, self.size = v, len(v)
        radius = np.abs(v).sum(axis=1) - np.abs(v.diagonal())
        self.scale = float((np.abs(v.diagonal()) + radius).max(initial=0))
        # Gershgorin's bounds, with some room.
        low, high = float((v.diagonal() - radius).min()), float((v.diagonal() + radius).max())
        room = 1e-6 * self.scale
        self.known = {low - room: self.size, high + room: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            plus, zero, _ = inertia(self.v - shift * np.eye(self.size))
            self.known[shift] = plus + zero
        return self.known[shift]

    def isolate(self, number: int, narrow: float) -> tuple[float, float]:
        """Bounds with fewer than ``number`` eigenvalues above the upper one and at least as many above the
        lower one: that eigenvalue alone, or no wider than ``narrow``."""
        while True:
            high = min(s for s, n in self.known.items() if n < number)
            low = max(s for s, n in self.known.items() if n >= number and s < high)
            if self.known[low] == number and self.known[high] == number - 1 or high - low <= narrow:
                return low, high
            middle = low + (high - low) / 2
            if not low < middle < high:
                return low, high
            self.above(middle)


def _step(v: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    """One step of inverse iteration; a shift that hits an eigenvalue is moved by rounding."""
    for nudge in (0.0, 4 * _EPS * scale, 64 * _EPS * scale):
        try:
            y = np.linalg.solve(v - (shift + nudge) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        size = np.linalg.norm(y)
        if np.isfinite(size) and size > 0:
            return y / size
    return x


def _apart(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The unit vector of ``x`` without its part along ``others``."""
    for u in others:
        x = x - u * (u @ x)
    return x / np.linalg.norm(x)


def leading(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above nothing and their unit vectors (columns), by falling value."""
    slices = Slices(v)
    least = NOTHING * float(np.trace(v))
    wanted = min(components, len(v))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    narrow = 32 * _EPS * slices.scale
    start = np.cos(np.arange(1, len(v) + 1) * 0.7) + 0.1
    for number in range(1, wanted + 1):
        if slices.scale == 0 or slices.above(max(least, narrow)) < number:
            break
        while True:
            low, high = slices.isolate(number, narrow)
            # Where several eigenvalues are left in a narrow slice, their vectors are told apart by
            # the start and by being orthogonal to those found.
            x = start * (1 + 0.3 * np.sin(number * np.arange(len(v))))
            near = [u for e, u in zip(values, vectors) if low - 64 * narrow <= e <= high + 64 * narrow]
            shift, misfit = low + (high - low) / 2, np.inf
            for turn in range(50):
                x = _apart(x, near)
                x = _apart(_step(v, shift, x, slices.scale), near)
                value = float(x @ v @ x)
                before, misfit = misfit, float(np.linalg.norm(v @ x - value * x))
                if misfit <= 8 * _EPS * slices.scale or turn > 4 and misfit > before / 2:
                    break
                # The first steps keep the middle of the slice, so that the iteration cannot leave it early.
                if turn >= 1 and low < value < high:
                    shift = value
            room = max(2 * misfit, narrow)
            done = misfit <= len(v) * narrow and slices.above(value + room) < number <= slices.above(value - room)
            if done or high - low <= narrow:
                break
            # The iteration ended at a neighbour, or not at all: cut the slice further.
            middle = low + (high - low) / 2
            if not low < middle < high:
                break
            slices.above(middle)
        # What rounding left of earlier vectors is in proportion to one over the gap of the values.
        x = _apart(x, vectors)
        values.append(value)
        vectors.append(x)
    if not values:
        return np.zeros(0), np.zeros((len(v), 0))
    order = np.argsort(-np.asarray(values), kind="stable")
    return np.asarray(values)[order], np.asarray(vectors)[order].T


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: one row of each
    usable vector and component."""
    spark = embeddings.sparkSession
    rows = settle(
        embeddings.filter(usable(F.col(vector))).select(F.col("vec_id").cast("long"), whole(F.col(vector), scale).alias("x")), "vectors"
    )
    fit = settle(rows.select("x").distinct(), "fit")
    n, shortest, longest = fit.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return spark.createDataFrame([], OUTPUT)
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} to {longest} entries: all must have one length")
    sums = _totals(fit)
    mean = np.asarray([float(Fraction(s, n)) for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        z = x - mean
        return z.T @ z

    v = _added(fit, products) / n
    v = (v + v.T) / 2
    values, vectors = leading(v, components)
    if not len(values):
        return spark.createDataFrame([], OUTPUT)
    explained = values / np.trace(v)
    project = vectors / np.sqrt(values)

    middle = _added(fit, lambda x: ((x - mean) @ project).sum(axis=0, keepdims=True))[0] / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ project - middle
        return w.T @ w

    error = float(np.abs(_added(fit, spread) / n - np.eye(len(values))).max())
    exact = np.asarray(sums, dtype=object)
    fits = max(abs(s) for s in sums) < _LONG / 4

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), batch.num_rows, np.int64)
            if fits and float(np.abs(x).max()) * n < _LONG / 4:
                apart = n * x - exact.astype(np.int64)
                size = (apart.astype(float) ** 2).sum(axis=1)
            else:
                size = np.full(1, np.inf)
            if size.max() >= _LONG * 0.999:
                raise OverflowError("a sum of squares of n * x - S exceeds a long")
            deviation = (apart * apart).sum(axis=1)
            white = (x - mean) @ project
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(batch.num_rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(batch.num_rows * k, n)),
                    pa.array(np.repeat(deviation, k)),
                    pa.array(white.reshape(-1)),
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array(np.full(batch.num_rows * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(apply, OUTPUT)
