"""Importance resampling towards a target: hashed n-gram features, gains per bucket, weighted draw.

Every document gets the sum of its features' gains, the log ratio of a bucket's share in the target
and in the documents. Gumbel noise from a hash of the id turns the largest sums into a weighted
sample without replacement.

Features are hashed whole arrays at a time. A CRC-32 is linear: the checksum of a span is the XOR of
one table entry per byte, chosen by the byte and its distance from the end of the span, and of a
constant for the length. So a text's bytes become entries of a position table in one step, and
``bitwise_xor.reduceat`` over the feature spans gives all checksums. Spans longer than the table fold
block by block: the four bytes of the state so far count as the first bytes of the block that follows.

A task sees one slice of texts at a time. The documents are read twice, once for the bucket counts,
at most one row a bucket, and once for the sums; neither shuffles a text. The draw sorts (score, id)
by ranges and numbers each range from the count of rows before it.

Defined results: null text has no words, so no features and weight 0; every input row is a document,
repeated or not; equal scores go by smaller ``doc_id``, nulls last, then by weight and size, so that
only equal rows can change places; a null id hashes as an empty one; empty tables draw none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailsift.llm.common import text_slices, written
from mailsift.operators.order import numbered

BUCKETS = 10_000
MOST_WORDS = 1  # features are runs of one to so many words
LEAST_WORDS = 20  # documents that may be drawn
PERCENT = 10
SEED = 2024
PIECE = 2_000_000  # bytes hashed at once
NEXT_WORD = re.compile(rb" *[^ ]*")
REACH = 64  # bytes of a span that the position table covers; at least four
POLYNOMIAL = 0xEDB88320

# ASCII digits and letters and all bytes from 0x80 on are words, A-Z lowered; anything else is a space.
TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def position_table(reach: int = REACH) -> np.ndarray:
    """(distance from the end, byte) -> its share of a CRC register that starts at zero."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> 1) ^ np.uint32(POLYNOMIAL), row >> 1).astype(np.uint32)
    table = np.empty((reach, 256), np.uint32)
    table[0] = row
    for distance in range(1, reach):
        before = table[distance - 1]
        table[distance] = (before >> 8) ^ row[before & 0xFF]
    return table


TABLE = position_table()


def _fold(state: np.ndarray, size: int) -> np.ndarray:
    """The registers ``state`` after ``size`` zero bytes, 4 to ``REACH`` of them."""
    out = np.zeros_like(state)
    for byte in range(4):
        out ^= TABLE[size - 1 - byte][(state >> np.uint32(8 * byte)) & np.uint32(0xFF)]
    return out


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of as many zero bytes: what the start value and the last complement add."""
    sizes, where = np.unique(lengths, return_inverse=True)
    found = np.empty(len(sizes), np.uint32)
    state, at = np.uint32(0xFFFFFFFF), 0
    for i, size in enumerate(sizes.tolist()):
        while size - at >= REACH:
            state, at = _fold(np.array([state]), REACH)[0], at + REACH
        while at < size:
            state, at = (state >> np.uint32(8)) ^ TABLE[0][state & np.uint32(0xFF)], at + 1
        found[i] = state ^ np.uint32(0xFFFFFFFF)
    return found[where]


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:stop]`` for spans that are not empty, rise and do not overlap."""
    if not len(starts):
        return np.empty(0, np.uint32)
    lengths = stops - starts
    blocks = -(-lengths // REACH)
    last = np.cumsum(blocks)
    # Blocks are cut from the end of a span, so that only its first one may be short.
    of = np.repeat(np.arange(len(starts)), blocks)
    high = stops[of] - (last[of] - 1 - np.arange(len(of))) * REACH
    low = np.maximum(starts[of], high - REACH)
    sizes = high - low
    begin = np.cumsum(sizes) - sizes
    positions = np.arange(int(sizes.sum())) + np.repeat(low - begin, sizes)
    distance = np.repeat(high - 1, sizes) - positions
    parts = np.bitwise_xor.reduceat(TABLE[distance, data[positions]], begin)
    first = last - blocks
    state = parts[first]
    for number in range(1, int(blocks.max())):
        longer = np.flatnonzero(blocks > number)
        state[longer] = _fold(state[longer], REACH) ^ parts[first[longer] + number]
    return state ^ length_constants(lengths)


def _pieces(data: bytes, most: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, end of the starts) of pieces cut at spaces; what follows the end completes runs begun before."""
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + PIECE)
        stop = len(data) if stop < 0 else stop
        far = stop
        for _ in range(most - 1):
            far = NEXT_WORD.match(data, far).end()
        yield data[start:far], stop - start
        start = stop


def _hashes(block: list[tuple[int, bytes, int]], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row numbers, checksums, run length) of all runs that start within the ends of the pieces."""
    data = np.frombuffer(b" ".join([b""] + [piece for _, piece, _ in block] + [b""]), np.uint8)
    begin = np.cumsum([1] + [len(piece) + 1 for _, piece, _ in block])
    letter = data != 0x20
    starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    stops = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    piece = np.searchsorted(begin, starts, "right") - 1
    counted = starts < begin[piece] + np.array([end for _, _, end in block] or [0])[piece]
    row = np.array([number for number, _, _ in block] or [0])[piece]
    if most > 1:  # one space between the words of a run
        kept = letter.copy()
        kept[stops] = True
        place = np.cumsum(kept) - 1
        data, starts, stops = data[kept], place[starts], place[stops]
    for length in range(1, most + 1):
        for shift in range(length):  # every other run at once, so that spans never overlap
            first = np.arange(shift, len(starts) - length + 1, length)
            first = first[counted[first] & (piece[first] == piece[first + length - 1])]
            yield row[first], crc32_of_spans(data, starts[first], stops[first + length - 1]), length


def feature_hashes(texts: Iterable[bytes | None], most: int = MOST_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Blocks of (text numbers, checksums of their features, words in each), of bounded size."""
    block, size = [], 0
    for number, text in enumerate(texts):
        for piece, end in _pieces((text or b"").translate(TO_WORDS), most):
            block.append((number, piece, end))
            size += len(piece)
            if size >= PIECE:
                yield from _hashes(block, most)
                block, size = [], 0
    if block:
        yield from _hashes(block, most)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = MOST_WORDS) -> np.ndarray:
    """Features per bucket over all rows of ``text``; every task sends at most a row a bucket."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in text_slices(batches):
            for _, hashes, _ in feature_hashes(piece.column("text").cast(pa.binary()).to_pylist(), most):
                total += np.bincount(hashes % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, np.int64)
    for row in found:
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio of the smoothed shares) of every bucket."""
    s, t, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(float((b + 1) * (s + k)) / float((a + 1) * (t + k)))) for a, b in zip(source.tolist(), target.tolist())
    ], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, most: int = MOST_WORDS) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of every document."""
    buckets = len(gain)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            features, words, weight = np.zeros((3, piece.num_rows), np.int64)
            for rows, hashes, length in feature_hashes(piece.column("text").cast(pa.binary()).to_pylist(), most):
                seen = np.bincount(rows, minlength=piece.num_rows)
                features += seen
                words += seen if length == 1 else 0
                np.add.at(weight, rows, gain[hashes % np.uint32(buckets)])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(features), pa.array(words), pa.array(weight)], names=["doc_id", "n_features", "n_words", "weight"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(weigh, f"doc_id {id_type}, n_features long, n_words long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, most: int = MOST_WORDS, least: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """Every document's features, weight and score, and its rank among those drawn."""
    gain = gains(bucket_counts(docs, buckets, most), bucket_counts(target, buckets, most))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")
    scored = written(weighed(docs, gain, most).withColumn("score", score), "importance-scores")
    may = scored.where(F.col("n_words") >= least)
    drawn = may.count() * percent // 100
    order = ["_down", "_no_id", "doc_id", "weight", "n_features"]
    placed = numbered(may.withColumns({"_down": -F.col("score"), "_no_id": F.col("doc_id").isNull()}), order, "rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank"))
    rest = scored.where(F.col("n_words") < least).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.union(rest)


ORACLE = r"""
WITH bits AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i)
  )
), d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM d
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), u AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM w UNION SELECT word FROM b)
), c AS (
  SELECT word, xor(list_reduce(list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT),
    lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM u, bits
), s AS (SELECT bucket, count(*) AS n FROM w JOIN c USING (word) GROUP BY ALL),
t AS (SELECT bucket, count(*) AS n FROM b JOIN c USING (word) GROUP BY ALL),
g AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM w) + 10000))::DOUBLE
    / ((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM b) + 10000))::DOUBLE))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)
), f AS (SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight FROM w JOIN c USING (word) JOIN g USING (bucket) GROUP BY ALL),
x AS (
  SELECT d.doc_id, coalesce(f.n, 0) AS n_features, coalesce(f.weight, 0) AS weight, coalesce(f.weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN f USING (id)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n FROM x
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM r
"""


def result(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target)
