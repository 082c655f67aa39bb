"""What several operators share: words and their hashes, whole groups, links to components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from mailsift.session import bounded_side, written

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
NO_ID = (1 << 63) - 1  # rows without an id come after all others
SLICE_CHARS = 4_000_000  # text handled at once inside a task
BROADCAST_ROWS = 100_000  # a side is broadcast only if counted and not longer than this


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; a null text has none."""
    blanks = [" ", "\t", "\n", "\x0b", "\f", "\r"]
    ends = F.substring(text, 1, 1).isin(blanks).cast("long") + F.substring(text, -1, 1).isin(blanks).cast("long")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(
        F.size(F.split(text, SPACE, -1)) - ends
    ).cast("long")


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 words between the six ASCII white-space characters, with A-Z lowered if asked for.

    Both are what ``bytes`` methods do: they know no other white space and no other letters.
    """
    if text is None:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, n: int, multiplier: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """One hash per run of ``n`` consecutive words; fewer words give none."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total, m = hashes[:count].copy(), np.uint64(multiplier)
    for j in range(1, n):
        total *= m
        total += hashes[j : j + count]
    return scramble(total)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds one row or at most ``most`` bytes of text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        start = total = 0
        for i, length in enumerate(lengths):
            if i > start and total + length > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += length
        if start < batch.num_rows:
            yield batch.slice(start)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that never cut a run of equal long keys; the input is sorted by ``key``."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable over the links, for every id that has one.

    Alternating large-star and small-star rounds; each is two aggregations and two joins on
    narrow rows, the number of rounds is logarithmic and no group is ever gathered. Every round is written to
    the shared folder, and the work ends when a round changes nothing. Hot vertices are met
    only by ``min`` aggregates, which combine before the shuffle, and by a join that adaptive
    execution may split.
    """
    edges = written(
        links.select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v"))
        .where("u <> v").distinct(), "links",
    )
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u is tied to the smallest of u and its neighbours.
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("v"), F.col("m").alias("u"))
            .where("u <> v").distinct()
        )
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .union(low.select("v", F.col("m").alias("u"))).where("u <> v").distinct()
        )
        new = written(small.select("u", "v"), "links")
        state = [d.select(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first() for d in (edges, new)]
        edges = new
        if state[0] == state[1]:
            break
    members = edges.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return members.union(edges.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct())


def small_side(df: DataFrame) -> DataFrame:
    """Marked for broadcast only if it was counted and is short; otherwise adaptive execution decides."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def chunk_numbers(df: DataFrame, group: str, order: list[str], size: int, least: int = 1) -> DataFrame:
    """Add ``chunk`` (0, 1, ...) and ``chunks``: pieces of about ``size`` rows of each group, by hash.

    Groups of fewer than ``least`` rows are left out: they hold no pair.

    The number of pieces comes from a count per group; rows are dealt by their hash, so no group
    is ever sorted or gathered to number its rows.
    """
    counts = df.groupBy(group).agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("chunks"), F.count("*").alias("_n"))
    counts = counts.where(F.col("_n") >= least).drop("_n")
    return df.join(counts, group).withColumn("chunk", F.pmod(F.xxhash64(*order), F.col("chunks")).cast("int"))


def unit_rows(df: DataFrame, group: str, unit: str = "unit") -> DataFrame:
    """Send every row to each pair of pieces that its own piece is part of.

    Adds ``unit`` (a long naming the pair of pieces), ``low`` and ``high`` (the pair). Two rows of a
    group meet in exactly one unit: that of their two pieces.
    """
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least(other, F.col("chunk")).alias("low"), F.greatest(other, F.col("chunk")).alias("high")),
    )
    return df.withColumn("_pair", F.explode(pairs)).select(
        *df.columns, F.xxhash64(group, "_pair.low", "_pair.high").alias(unit), "_pair.low", "_pair.high",
    )


__all__ = [
    "NO_ID", "SPACE", "WORD", "bounded_side", "chunk_numbers", "components", "gram_hashes", "scramble", "small_side", "text_slices",
    "unit_rows", "whole_groups", "word_count", "word_hashes", "words_of", "written",
]
