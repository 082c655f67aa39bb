"""Minima of penalised losses of a linear margin, by passes over the distributed rows.

Spark's own learners descend on features divided by their deviations: the even penalty of the published
objective becomes a very uneven one there, and a fit takes thousands of passes. Here the coefficients
themselves descend, by limited-memory quasi-Newton steps. A pass sends the coefficients to the tasks and
gets back one gradient for each; the rows are cut into blocks once.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from mailsift.session import written

MEMORY = 40  # steps that the curvature is estimated from
BLOCK = "fold int, places binary, numbers binary, sizes binary, label binary, weight binary"
KINDS = (np.int32, float, np.int64, float, float)

# A loss takes margins and labels and gives (loss, slope) of every row.
Loss = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass
class Point:
    """Where a descent stands: coefficients with the intercept last, the penalised loss and its gradient."""

    at: np.ndarray
    loss: float
    gradient: np.ndarray


class Unfinished(RuntimeError):
    """The passes were used up before the minimum."""


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The logistic loss of labels 0 and 1."""
    small = np.exp(-np.abs(margin))
    p = np.where(margin >= 0, 1.0, small) / (1.0 + small)
    return np.maximum(margin, 0.0) + np.log1p(small) - label * margin, p - label


def margins(places: np.ndarray, numbers: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rows' numbers times their coefficients, and the intercept."""
    out, filled = np.zeros(len(sizes)), sizes > 0
    if len(places):
        out[filled] = np.add.reduceat(numbers * at[places], (np.cumsum(sizes) - sizes)[filled])
    return out + at[-1]


def summed(places: np.ndarray, numbers: np.ndarray, sizes: np.ndarray, slope: np.ndarray, size: int) -> np.ndarray:
    """The rows' numbers times their slopes, added up by place."""
    return np.bincount(places, numbers * np.repeat(slope, sizes), size)


class Rows:
    """Rows with ``features``, ``label`` and a weight, written once as blocks of sparse numbers; a block has rows of one fold."""

    def __init__(self, df: DataFrame, weight: str | None = None, features: str = "features", fold: str | None = None) -> None:
        opened = df.select(
            F.unwrap_udt(features).alias("u"), F.col("label").cast("double").alias("label"),
            (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"),
        )
        parts = opened.select(F.col("u.size").alias("size"), F.col("u.indices").alias("places"), F.col("u.values").alias("numbers"), "label", "weight", "fold")
        total, size = parts.agg(F.sum("weight"), F.max(F.coalesce("size", F.size("numbers")))).first()
        if not total:
            raise ValueError("There are no rows to fit on.")
        self.total, self.size = float(total), int(size)
        self.context = df.sparkSession.sparkContext
        blocks = written(parts.drop("size").mapInArrow(_blocks, BLOCK), "blocks").coalesce(2 * self.context.defaultParallelism)
        # Every pass reads the blocks again, so they are kept; a lost one is read anew.
        self.blocks = blocks.rdd.map(lambda row: (row[0], *map(bytes, row[1:]))).persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self) -> "Rows":
        return self

    def __exit__(self, *error) -> None:
        self.blocks.unpersist()

    def run(self, task: Callable[[Iterator[tuple]], Iterator]) -> list:
        """One pass: ``task`` over every partition's blocks, each its fold and arrays; one result a task, whatever the number of rows."""
        opened = lambda block: (block[0], *map(np.frombuffer, block[1:], KINDS))
        return self.blocks.mapPartitions(lambda blocks: task(map(opened, blocks))).collect()

    def point(self, at: np.ndarray, loss: Loss, penalty: float) -> Point:
        """The loss with half the ``penalty`` times the squared coefficients; the intercept is free."""
        shared, size = self.context.broadcast(at), self.size

        def run(blocks: Iterator[tuple]) -> Iterator[tuple[np.ndarray, float]]:
            w, gradient, whole = shared.value, np.zeros(size + 1), 0.0
            for _, places, numbers, sizes, label, weight in blocks:
                value, slope = loss(margins(places, numbers, sizes, w), label)
                slope = slope * weight
                gradient[:-1] += summed(places, numbers, sizes, slope, size)
                gradient[-1] += slope.sum()
                whole += weight @ value
            yield gradient, whole

        parts = self.run(run)
        shared.destroy()
        gradient, whole = (np.sum(x, axis=0) for x in zip(*parts))
        coefficients = at[:-1]
        gradient[:-1] += penalty * coefficients
        return Point(at, float(whole + penalty * coefficients @ coefficients / 2), gradient)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for fold in pc.unique(batch.column("fold")).to_pylist():
            yield _block(batch.filter(pc.equal(batch.column("fold"), fold)), fold)


def _block(batch: pa.RecordBatch, fold: int) -> pa.RecordBatch:
    numbers = batch.column("numbers")
    sizes = numbers.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    places = batch.column("places")
    known = places.flatten().to_numpy().astype(np.int32)
    if places.null_count:  # dense vectors have no places
        at = np.split(known, np.cumsum(places.value_lengths().fill_null(0).to_numpy())[:-1])
        known = np.concatenate([np.arange(n, dtype=np.int32) if none else p for p, n, none in zip(at, sizes, places.is_null().to_pylist())])
    arrays = (known, numbers.flatten().to_numpy().astype(float), sizes, *(batch.column(c).to_numpy().astype(float) for c in ("label", "weight")))
    return pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)], names=[x.split()[0] for x in BLOCK.split(", ")])


def descend(rows: Rows, start: np.ndarray, loss: Loss, penalty: float, tol: float, most: int) -> tuple[Point, int]:
    """The lowest point and the steps it took.

    Under the penalty a loss cannot fall by more than the squared gradient over twice the penalty (the
    intercept is taken as if it had one): the descent ends where that is ``tol`` of the loss. ``most``
    steps without it are an error.
    """
    now = rows.point(start, loss, penalty)
    past: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=MEMORY)
    for step in range(most):
        if now.gradient @ now.gradient <= 2 * (penalty or 1.0) * tol * now.loss:
            return now, step
        direction = _newton(now.gradient, past)
        if now.gradient @ direction >= 0:
            past.clear()
            direction = -now.gradient
        length = 1.0 if past else 1.0 / max(1.0, float(np.linalg.norm(now.gradient)))
        after = _search(lambda t: rows.point(now.at + t * direction, loss, penalty), now, direction, length)
        if after is None:  # no lower point can be told from this one
            if not past:
                return now, step
            past.clear()
            continue
        past.append((after.at - now.at, after.gradient - now.gradient))
        now = after
    raise Unfinished(f"did not converge in {most} iterations")


def _newton(gradient: np.ndarray, past: deque[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the gradient times the inverse curvature that the past steps tell of."""
    out, shares = -gradient, []
    for s, y in reversed(past):
        shares.append(s @ out / (s @ y))
        out = out - shares[-1] * y
    if past:
        s, y = past[-1]
        out = out * (s @ y / (y @ y))
    for (s, y), share in zip(past, reversed(shares)):
        out = out + (share - y @ out / (s @ y)) * s
    return out


def _search(point: Callable[[float], Point], now: Point, direction: np.ndarray, length: float) -> Point | None:
    """A point along the direction that is low enough and past the steep part, by doubling and halving."""
    fall, low, high = float(now.gradient @ direction), 0.0, np.inf
    slack = 1e-15 * abs(now.loss)  # differences below rounding are none
    for _ in range(40):
        after = point(length)
        if after.loss > now.loss + 1e-4 * length * fall + slack:
            high = length
        elif after.gradient @ direction < 0.9 * fall:
            low = length
        else:
            return after
        length = (low + high) / 2 if np.isfinite(high) else 2 * length
    return None
