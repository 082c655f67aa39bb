"""Best-fit packing of token sequences, in bulk-synchronous rounds over classes of equal length.

A text becomes the ids of a public tokenizer and one end id; only what is longer than the capacity
is cut into pieces. Best fit gives the longest pieces first to the smallest gap that takes them.

Lengths and gaps are whole numbers up to the capacity, so both sorted orders are kept run-length
encoded: a class is all pieces of one length, a range is a run of sequences with one gap. A round
takes the next class in falling order and sweeps it over its successors among the gap ranges, in
rising order of the gap; ranks in the class resolve who gets which place; the gaps of the ranges
are updated and the next round begins. That is what one piece after the other would do, but the
classes are counted by Spark, and the plan has a row per (class, range) pair whatever the number of
documents. Every piece then finds its place from its rank: ranks come from counts per (part,
length) of the written piece table, so no length is ever gathered, however many pieces share it.

Defined results: a null or empty text is the end id alone; rows with equal ids are packed apart; an
empty table gives none. Pieces are numbered from 0 and start at the ids before them.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from mailsift.llm.common import text_slices, written

CAPACITY = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 150_000  # words of a generation that a worker keeps

# What the tokenizer takes for white space; ``str.split`` also takes the four separators of ``ODD``.
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD = re.compile("[\x1c-\x1f]")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Byte-level models name each byte by a character: printable ones by themselves, the others from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_NAMES = {b: b for b in SHOWN} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(SHOWN))}
# A run of Latin-1 letters and a run of marks are pre-tokens of their own.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordIds:
    """Ids of a text, word by word: this tokenizer never joins what white space parts.

    Recent words keep their ids in two generations: a word used again moves to the young one, and
    when that is full it becomes the old one. A new word of plain letters goes straight to the
    tokenizer's model, and what marks follow are looked up apart; any other is encoded as a text.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _text(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _new(self, word: str) -> bytes:
        found = SIMPLE.fullmatch(word)
        if not found:
            return self._text(word)
        letters, marks = found.groups()
        if marks:
            return self._known(letters) + self._known(marks)
        named = letters.lower().encode().decode("latin-1").translate(BYTE_NAMES)
        return np.array([t.id for t in self.model.tokenize(named)], "<u4").tobytes()

    def _known(self, word: str) -> bytes:
        ids = self.young.get(word)
        if ids is None:
            ids = self.young[word] = self.old.get(word) or self._new(word)
        return ids

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [WHITE.split(t) if ODD.search(t) else t.split() for t in texts]
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        for word in set().union(*split).difference(self.young):
            self._known(word)
        get, end = self.young.__getitem__, np.array([END], "<u4").tobytes()
        for words in split:
            yield np.frombuffer(b"".join(map(get, words)) + end, "<u4")


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(path)
        for batch in text_slices(batches):
            rows: list[tuple] = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of.encode(texts)):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(columns)],
                names=[x.split()[0] for x in PIECES.split(", ")],
            )

    return run


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places of every class: (length, first rank, end rank, first sequence, pieces in each, offset).

    Rank ``r`` of the class goes to sequence ``first + (r - first rank) // each``, at ``offset`` plus
    ``(r - first rank) % each`` times the length. ``counts`` has at most ``capacity`` lengths.
    """
    ranges: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, number)
    gaps: list[int] = []  # the gaps in use, rising
    plan, opened = [], 0

    def put(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in ranges:
                bisect.insort(gaps, gap)
                ranges[gap] = []
            ranges[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, number = ranges[gap].pop()
                if not ranges[gap]:
                    del ranges[gap]
                    gaps.pop(at)
            else:
                gap, first = capacity, opened
                number = -(-left // (capacity // length))
                opened += number
            each = gap // length
            full = min(number, left // each)
            if full:
                plan.append((length, rank, rank + full * each, first, each, capacity - gap))
                put(gap - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < number:  # the last sequence of the class is filled in part
                plan.append((length, rank, rank + left, first + full, left, capacity - gap))
                put(gap - left * length, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            put(gap, first + full, number - full)
    return plan


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    import public_tokenizers

    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(path, capacity), PIECES)
    pieces = written(
        pieces.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "pack-pieces"
    )
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = written(by_part.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "pack-counts")
    # At most ``capacity`` rows come to the driver, however many documents there are.
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        best_fit_plan(counts, capacity), "size long, low long, high long, first long, each long, at long"
    ).coalesce(1)
    local = F.row_number().over(Window.partitionBy("length", "part").orderBy("row")) - 1
    ranked = pieces.withColumn("local", local).join(
        by_part.select(F.col("length").alias("_l"), F.col("part").alias("_p"), "before"),
        (F.col("length") == F.col("_l")) & (F.col("part") == F.col("_p")),
    ).withColumn("rank", F.col("before") + F.col("local"))
    placed = ranked.join(
        F.broadcast(plan) if plan_is_short(counts, capacity) else plan,
        (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    within = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(within, F.col("each")) * F.col("length")).alias("offset"),
    )


def plan_is_short(counts: dict[int, int], capacity: int) -> bool:
    """Whether the plan may be broadcast: its rows are bounded by the square of the capacity, not by the data."""
    return len(counts) <= capacity <= 65_536


def result(docs: DataFrame) -> DataFrame:
    return pack(docs)
