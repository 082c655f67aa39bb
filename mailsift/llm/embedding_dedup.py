"""Near-duplicate vectors by cross-polytope hashing.

A hash applies random signs and a fast Hadamard transform three times and takes the coordinate
with the largest magnitude and its sign. ``HASHES`` of them, and more as the table grows, make a
bucket of a table; a vector also probes the buckets that replace one coordinate by the runner-up. Pairs
that share a bucket are verified by their cosine in double precision; no pair below the threshold is
ever a link.

Vectors of equal direction (bit by bit, once scaled by their largest component) are one class from
the start: its copies are counted, never paired. A link of two classes counts for each as many times as
the other has copies, and a class gives each of its own copies one link less than it has.

A bucket is dealt into pieces and every two pieces meet in one unit, so no bucket is gathered,
whatever its size. Pairs stay inside a unit: what leaves it is how many links each vector has there
and a spanning forest of them. A pair that meets in several buckets counts in the first of them
only, which both vectors' bucket lists tell.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing and are components of their own; vectors of different dimensions do not link; rows with
equal ids are rows of their own; a null id is named as such and comes last; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailsift.llm.common import NO_ID, chunk_numbers, components, scramble, unit_rows, whole_groups, written

THRESHOLD = 0.95
TABLES = 10
HASHES = 3
ROWS = 1 << 24  # classes up to which these numbers of tables and hashes hold
PIECE = 1024
SEED = 42

BUCKETS = "number long, dim int, buckets array<long>"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, half = x.shape[1], 1
    x = x.copy()
    while half < n:
        y = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def bucket_lists(vectors: np.ndarray, tables: int = TABLES, hashes: int = HASHES, seed: int = SEED) -> np.ndarray:
    """One row of bucket names per vector: for each table its own bucket and one probe per hash."""
    count, dim = vectors.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((count, width))
    padded[:, :dim] = vectors
    rng = np.random.default_rng(seed)
    out = []
    for table in range(tables):
        best, second = [], []
        for _ in range(hashes):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * rng.choice([-1.0, 1.0], width))
            size = np.abs(turned)
            top = np.argmax(size, 1)
            sign = np.take_along_axis(turned, top[:, None], 1)[:, 0] > 0
            best.append((top * 2 + sign).astype(np.uint64))
            np.put_along_axis(size, top[:, None], -1.0, 1)
            top = np.argmax(size, 1)
            sign = np.take_along_axis(turned, top[:, None], 1)[:, 0] > 0
            second.append((top * 2 + sign).astype(np.uint64))
        for probe in range(-1, hashes):
            name = np.full(count, table * 1_000_003 + dim, np.uint64)
            for h in range(hashes):
                name = scramble(name + (second[h] if h == probe else best[h]) + np.uint64(1))
            out.append(name)
    return np.stack(out, 1).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _hash(tables: int, hashes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                lists = bucket_lists(_matrix(part.column("vector")), tables, hashes, seed)
                yield pa.RecordBatch.from_arrays([
                    part.column("number"), part.column("dim"),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * lists.shape[1]), pa.array(lists.ravel())),
                ], names=["number", "dim", "buckets"])

    return run


def unit_links(
    vectors: np.ndarray, lists: np.ndarray, bucket: int, left: np.ndarray, right: np.ndarray, threshold: float, tables: int,
) -> np.ndarray:
    """Pairs (left, right) at the threshold for which ``bucket`` is the first that both lists have.

    A name tells its table, so only places of one table are compared.
    """
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    same = len(left) == len(right) and (left == right).all()
    i, j = np.nonzero(unit[left] @ unit[right].T >= threshold)
    i, j = left[i], right[j]
    if same:
        i, j = i[i < j], j[i < j]
    i, j = np.minimum(i, j), np.maximum(i, j)
    by_table = lists.reshape(len(lists), tables, -1)
    kept = []
    for start in range(0, len(i), 20_000):
        a, b = i[start : start + 20_000], j[start : start + 20_000]
        met = np.stack([
            (by_table[a, :, k, None] == by_table[b]).any(2) for k in range(by_table.shape[2])
        ], 2).reshape(len(a), -1)
        first = met.argmax(1)  # the first place of the left list that the right list has
        mine = met.any(1) & (lists[a, first] == bucket)
        kept.append(np.stack([a[mine], b[mine]], 1))
    return np.concatenate(kept) if kept else np.empty((0, 2), np.int64)


def hash_numbers(rows: int) -> tuple[int, int]:
    """(tables, hashes) for so many classes: buckets of unrelated vectors stay short, recall stays up.

    A hash of 64 dimensions has 128 values, so each further one is due at 128 times the rows; it takes
    twice the tables to find a pair at the threshold as often as before.
    """
    more = 0
    while rows > ROWS << (7 * more):
        more += 1
    return TABLES << more, HASHES + more


FOUND = "number long, links long, other long"


def _verify(threshold: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "unit"):
            frame = table.select(["number", "copies", "bucket", "dim", "chunk", "low", "high"]).to_pandas()
            out: list[pd.DataFrame] = []
            for (bucket, _, low, high), rows in frame.groupby(["bucket", "dim", "low", "high"], sort=False).indices.items():
                if len(rows) < 2:
                    continue
                part = table.take(pa.array(rows))
                number, chunk = frame["number"].to_numpy()[rows], frame["chunk"].to_numpy()[rows]
                order = np.argsort(number)  # the bucket list of the smaller number decides
                vectors, lists = _matrix(part.column("vector"))[order], _matrix(part.column("buckets"))[order]
                number, chunk = number[order], chunk[order]
                copies = frame["copies"].to_numpy()[rows][order]
                left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
                pairs = unit_links(vectors, lists, bucket, left, right, threshold, tables)
                if len(pairs):
                    out += _counts(number, copies, pairs)
            yield pa.RecordBatch.from_pandas(
                pd.concat(out) if out else pd.DataFrame(columns=["number", "links", "other"], dtype="int64"), preserve_index=False,
            )

    return run


def _counts(number: np.ndarray, copies: np.ndarray, pairs: np.ndarray) -> list[pd.DataFrame]:
    """Links of every class of a unit, with one tree edge where the class first joins another tree."""
    degree = np.zeros(len(number), np.int64)
    np.add.at(degree, pairs[:, 0], copies[pairs[:, 1]])
    np.add.at(degree, pairs[:, 1], copies[pairs[:, 0]])
    parent = np.arange(len(number))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges: list[tuple[int, int]] = []
    for a, b in pairs[np.argsort(pairs[:, 0], kind="stable")]:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
            edges.append((a, b))
    met = np.flatnonzero(degree)
    counts = pd.DataFrame({"number": number[met], "links": degree[met], "other": number[met]})
    tree = np.array(edges, np.int64).reshape(-1, 2)
    return [counts, pd.DataFrame({"number": number[tree[:, 0]], "links": 0, "other": number[tree[:, 1]]})]


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, tables: int | None = None, hashes: int | None = None, seed: int = SEED,
) -> DataFrame:
    """(id, n_links, component, kept): a row for every row of (vec_id, embedding)."""
    rows = vectors.select(
        F.coalesce(F.col("vec_id"), F.lit(NO_ID)).cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
    ).withColumn("number", F.monotonically_increasing_id())
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("vector", lambda x: x == 0)
    usable = F.coalesce(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad & ~zero, F.lit(False))
    # Scaled by the largest component, so that no square overflows or vanishes; cosines stay as they are.
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    scaled = F.transform("vector", lambda x: x / largest + F.lit(0.0))  # one zero only
    rows = rows.withColumn("vector", F.when(usable, scaled))
    # Two hashes of 64 bits name a direction; what links with nothing is named by its row.
    named = lambda first, last: F.when(F.col("vector").isNotNull(), F.xxhash64(*first, "vector", *last)).otherwise(F.col("number"))
    rows = written(
        rows.withColumn("one", named([], [F.lit(1)])).withColumn("two", named([F.lit(2)], [])), "vectors"
    )
    classes = written(
        rows.where(F.col("vector").isNotNull()).groupBy("one", "two").agg(F.min("number").alias("number"), F.count("*").alias("copies")),
        "vector-classes",
    )
    if tables is None or hashes is None:
        sized = hash_numbers(classes.count())
        tables, hashes = tables or sized[0], hashes or sized[1]
    distinct = written(
        rows.select("number", "vector").join(classes.select("number", "copies"), "number").withColumn("dim", F.size("vector")),
        "vector-distinct",
    )
    listed = written(
        distinct.select("number", "dim", "vector").mapInArrow(_hash(tables, hashes, seed), BUCKETS), "vector-buckets"
    )
    members = listed.select("number", "dim", F.explode(F.array_distinct("buckets")).alias("bucket"))
    dealt = chunk_numbers(members.withColumn("group", F.xxhash64("bucket", "dim")), "group", ["number"], PIECE, least=2)
    units = unit_rows(dealt, "group")
    full = listed.drop("dim").join(distinct.select("number", "vector", "copies"), "number")
    units = units.join(full, "number").select("unit", "number", "copies", "bucket", "dim", "chunk", "low", "high", "vector", "buckets")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = written(
        units.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(_verify(threshold, tables), FOUND), "vector-links"
    )
    degrees = found.where("links > 0").groupBy(F.col("number").alias("_d")).agg(F.sum("links").alias("links"))
    joined = components(found.where("links = 0").select(F.col("number").alias("a"), F.col("other").alias("b")))
    linked = written(
        classes.join(degrees, F.col("number") == F.col("_d"), "left")
        .join(joined.withColumnRenamed("id", "_j"), F.col("number") == F.col("_j"), "left")
        .select(
            F.col("one").alias("_one"), F.col("two").alias("_two"), F.coalesce("component", "number").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        ), "vector-linked",
    )
    located = written(
        rows.select("number", "id", "one", "two")
        .join(linked, (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")), "left")
        .select("number", "id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "number").alias("component")),
        "vector-located",
    )
    first = located.groupBy(F.col("component").alias("_c")).agg(F.min(F.struct("id", "number")).alias("first"))
    return located.join(first, F.col("component") == F.col("_c")).select(
        "id", "n_links", F.col("first.id").alias("component"), (F.col("first.number") == F.col("number")).alias("kept")
    )


def result(vectors: DataFrame) -> DataFrame:
    found = near_duplicates(vectors.select("vec_id", "embedding"))
    real = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return found.select(real("id").alias("vec_id"), "n_links", real("component").alias("component_id"), "kept")
