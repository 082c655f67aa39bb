"""Leading singular values of distributed rows, by passes that multiply many vectors at once.

A block Lanczos method on the Gram matrix: a pass sends ``WIDTH`` vectors to the tasks, which hold the rows
as blocks of sparse numbers, and gets back their products, summed by ranges of features in a shuffle. The
number of passes is that of blocks, not of vectors, and does not depend on the number of rows; the driver
holds features x ``MOST`` x components numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from mailsift.session import written

WIDTH = 32  # vectors multiplied in a pass
MOST = 3  # times the components: largest number of vectors before all but the best are left
TOLERANCE = 1e-10  # largest residual of a singular vector, relative to its value squared
PASSES = 2000
ENTRIES = 1 << 20  # numbers in a block of rows
RANGES = 16  # ranges of features whose sums meet apart
NOISE = 1e-14  # directions shorter than this, relative to the largest value squared, are rounding
LEAST = 1e-9  # singular values below this, relative to the first, are left out
BLOCK = "height long, rows binary, numbers binary, features binary, starts binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of rows, their numbers in the order of the features."""
    for batch in batches:
        values, places = batch.column("values"), batch.column("places")
        sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        known = places.flatten().to_numpy().astype(np.int32)
        if places.null_count:  # dense vectors have no places
            at = np.split(known, np.cumsum(places.value_lengths().fill_null(0).to_numpy())[:-1])
            known = np.concatenate([np.arange(n, dtype=np.int32) if none else p for p, n, none in zip(at, sizes, places.is_null().to_pylist())])
        numbers, ends = values.flatten().to_numpy().astype(float), np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + ENTRIES, "right")))
            own = slice(done, int(ends[stop - 1]))
            order = np.argsort(known[own], kind="stable")
            row = np.repeat(np.arange(stop - start, dtype=np.int32), sizes[start:stop])[order]
            feature = known[own][order]
            starts = np.flatnonzero(np.append(np.ones(min(1, len(feature)), bool), feature[1:] != feature[:-1]))
            arrays = (row, numbers[own][order], feature[starts], starts.astype(np.int32))
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([stop - start]), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)], names=[x.split()[0] for x in BLOCK.split(", ")]
                )
            start = stop


class Gram:
    """The product of the rows' Gram matrix with some vectors, in one pass over rows that are written once."""

    def __init__(self, df: DataFrame, vector_col: str) -> None:
        opened = df.select(F.unwrap_udt(vector_col).alias("u"))
        parts = opened.select(F.col("u.size").alias("size"), F.col("u.indices").alias("places"), F.col("u.values").alias("values"))
        self.size = int(parts.agg(F.max(F.coalesce("size", F.size("values")))).first()[0] or 0)
        self.context = df.sparkSession.sparkContext
        blocks = written(parts.drop("size").mapInArrow(_blocks, BLOCK), "row-blocks").coalesce(2 * self.context.defaultParallelism)
        # Every pass reads the blocks again, so they are kept; a lost one is read anew.
        self.blocks = blocks.rdd.map(lambda row: (row[0], *map(bytes, row[1:]))).persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self) -> "Gram":
        return self

    def __exit__(self, *error) -> None:
        self.blocks.unpersist()

    def times(self, vectors: np.ndarray) -> np.ndarray:
        shared = self.context.broadcast(np.ascontiguousarray(vectors.T))

        def run(blocks: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
            x = shared.value
            out = np.zeros_like(x)
            for height, *block in blocks:
                rows, numbers, features, starts = map(np.frombuffer, block, (np.int32, float, np.int32, np.int32))
                rows, held, starts = rows.astype(np.intp), np.diff(np.append(starts, len(rows))), starts.astype(np.intp)
                for j in range(len(x)):
                    product = np.bincount(rows, np.repeat(x[j, features], held) * numbers, height)[rows]
                    product *= numbers
                    out[j, features] += np.add.reduceat(product, starts)
            yield from enumerate(np.array_split(out, RANGES, axis=1))

        sums = dict(self.blocks.mapPartitions(run).reduceByKey(np.add, RANGES).collect())  # one matrix like ``vectors``, whatever the number of rows
        shared.destroy()
        return np.concatenate([sums[i] for i in range(RANGES)], axis=1).T if sums else np.zeros_like(vectors)


def _apart(vectors: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What the basis does not hold of some vectors; taken off twice, against rounding."""
    for _ in range(2):
        vectors = vectors - basis @ (basis.T @ vectors)
    return vectors


def leading(times: Callable[[np.ndarray], np.ndarray], size: int, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix without negative ones, and their vectors.

    Where the vectors found take in all that follows from the first block, fresh ones are added, until
    these raise no value: values may be repeated more often than a block is wide.
    """
    k, random = min(k, size), np.random.default_rng(seed)
    most = max(MOST * k, k + 3 * WIDTH)
    basis, inner, settled = np.empty((size, 0)), np.empty((0, 0)), -1.0
    new = np.linalg.qr(random.standard_normal((size, min(WIDTH, size))))[0]
    for _ in range(PASSES):
        product = times(new)
        basis = np.hstack([basis, new])
        cross = basis.T @ product
        inner = np.block([[inner, cross[: len(inner)]], [cross.T]])
        values, turn = (x[..., ::-1] for x in np.linalg.eigh((inner + inner.T) / 2))
        # The residual of every vector lies in what the newest product adds to the basis.
        rest, mixed = np.linalg.qr(_apart(product, basis))
        left, long, right = np.linalg.svd(mixed)
        some = long > NOISE * max(values[0], 0.0)
        residual = np.linalg.norm((long[:, None] * right) @ turn[-new.shape[1] :, :k], axis=0)
        rank = int((values[:k] > NOISE * max(values[0], 0.0)).sum())
        spent = not some.any()
        if basis.shape[1] >= size or (not spent and len(values) >= k and (residual <= TOLERANCE * values[:k])[:rank].all()):
            break
        if spent and sum(values[:k]) <= settled * (1 + TOLERANCE):
            break
        if basis.shape[1] + WIDTH > most:
            keep = k + 2 * WIDTH
            basis, inner = basis @ turn[:, :keep], np.diag(values[:keep])
        if spent:
            settled = sum(values[:k])
            width = min(WIDTH, size - basis.shape[1])
            new = np.linalg.qr(_apart(np.linalg.qr(_apart(random.standard_normal((size, width)), basis))[0], basis))[0]
        else:
            new = np.linalg.qr(_apart(rest @ left[:, some], basis))[0]
    else:
        raise RuntimeError(f"The singular vectors did not settle in {PASSES} passes.")
    return values[:k], basis @ turn[:, :k]


def fit(df: DataFrame, vector_col: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading singular values and right vectors of the rows; vanishing values are left out."""
    with Gram(df, vector_col) as gram:
        squares, right = leading(gram.times, gram.size, k)
    values = np.sqrt(np.maximum(squares, 0.0))
    some = values > LEAST * values[0] if len(values) else np.zeros(0, bool)
    return values[some], right[:, some]
