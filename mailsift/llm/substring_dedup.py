"""Removal of long passages that an earlier document has, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. The minimiser of a window is the smallest
hash of its ``MER``-word runs; consecutive windows with the same minimiser form a super-k-mer.

1. A pass over the texts writes a narrow row per document with its super-k-mers (minimiser, first
   window, number of windows), its word count and the digest of its words.
2. Equal windows have equal minimisers, so only minimisers that two documents have can hold a
   repeated window. A count per minimiser, combined before its shuffle, finds them.
3. Documents with such super-k-mers send them, each as one packed string of its words, to the bucket
   of their minimiser. A task sorts its bucket and ranks the windows by their words, exactly, by
   prefix doubling; windows whose words start in a document with a smaller id are reported as spans.
   Equal packed strings need no bucket: the smallest id per string is a ``min`` aggregate that
   combines before its shuffle, every larger id loses all windows of the string, and only the
   strings of the smallest id travel on.
4. A minimiser that still has more than ``HOT`` super-k-mers is not gathered. Its windows become rows
   of their own with a 128-bit digest, and the smallest id per digest is found in the same way.

Defined results: null and empty texts have no words; a text of fewer than ``WINDOW`` words keeps all
of them; rows with equal ids never remove words from each other; a null id counts as larger than
all others; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailsift.llm.common import NO_ID, gram_hashes, small_side, text_slices, whole_groups, word_hashes, words_of, written

WINDOW = 50
MER = 8
HOT = 2000

SCANNED = (
    "id long, digest string, n_words long, kept_sha256 string, minimisers array<long>, starts array<int>, counts array<int>"
)
CUT = "minimiser long, id long, digest string, start int, count int, packed binary"
SINGLE = "id long, digest string, start int, high long, low long"


def super_kmers(words: list[bytes], window: int = WINDOW, mer: int = MER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of every super-k-mer of a text."""
    count = len(words) - window + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    low = gram_hashes(word_hashes(words), mer)
    width, span = window - mer + 1, 1
    while span * 2 <= width:  # minima over doubling spans, then over the two that cover the width
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:count], low[width - span : width - span + count])
    starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    counts = np.diff(np.append(starts, count))
    return low[starts].view(np.int64), starts.astype(np.int32), counts.astype(np.int32)


def _ragged(parts: list[np.ndarray], kind: pa.DataType, dtype) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.empty(0, dtype), kind))


def _scan(window: int, mer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sizes, digests, found = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                sizes.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                found.append(super_kmers(words, window, mer))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("digest"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                _ragged([f[0] for f in found], pa.int64(), np.int64), _ragged([f[1] for f in found], pa.int32(), np.int32),
                _ragged([f[2] for f in found], pa.int32(), np.int32),
            ], names=["id", "digest", "n_words", "kept_sha256", "minimisers", "starts", "counts"])

    return run


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _cut(window: int):
    """Documents with their shared super-k-mers -> one packed string for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            rows: list[tuple] = []
            for id_, digest, text, parts in zip(*(batch.column(c).to_pylist() for c in ("id", "digest", "text", "parts"))):
                words = words_of(text)
                for part in parts:
                    start, count = part["start"], part["count"]
                    rows.append((part["minimiser"], id_, digest, start, count, b" ".join(words[start : start + count + window - 1])))
                if len(rows) > 20_000:
                    yield _batch(rows, CUT)
                    rows = []
            yield _batch(rows, CUT)

    return run


def _windows(window: int):
    """Packed strings -> a 128-bit digest of each of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for id_, digest, start, packed in zip(*(batch.column(c).to_pylist() for c in ("id", "digest", "start", "packed"))):
                hashes = word_hashes(packed.split(b" "))
                high, low = gram_hashes(hashes, window).view(np.int64), gram_hashes(hashes, window, 0xD1342543DE82EF95).view(np.int64)
                rows += [(id_, digest, start + i, h, l) for i, (h, l) in enumerate(zip(high.tolist(), low.tolist()))]
            yield _batch(rows, SINGLE)

    return run


def repeated_windows(packed: list[bytes], ids: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last window (end exclusive) of the runs of windows that start in a smaller id too.

    Windows are ranked by their words: ranks of 1, 2, 4, ... words come from pairs of ranks of half as many.
    """
    split = [p.split(b" ") for p in packed]
    sizes = np.array([len(s) for s in split], np.int64)
    row = np.repeat(np.arange(len(split)), sizes)
    ranks, _ = pd.factorize(np.array([w for s in split for w in s] + [b""], object)[:-1])
    ranks, span = ranks.astype(np.int64), 1
    distinct = int(ranks.max()) + 1
    while span * 2 <= window:
        codes, names = pd.factorize(ranks[:-span] * distinct + ranks[span:])
        ranks, distinct, span = codes.astype(np.int64), len(names), span * 2
    if span < window:
        rest = window - span
        codes, names = pd.factorize(ranks[:-rest] * distinct + ranks[rest:])
        ranks, distinct = codes.astype(np.int64), len(names)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(place <= np.repeat(sizes, sizes) - window)  # windows inside one packed string
    rank, owner, place = ranks[at], row[at], place[at]
    least = np.full(distinct, NO_ID, np.int64)
    order = np.lexsort((ids[owner], rank))
    head = np.concatenate([[True], rank[order][1:] != rank[order][:-1]])
    least[rank[order][head]] = ids[owner][order][head]
    hit = np.flatnonzero(least[rank] < ids[owner])
    if not len(hit):
        return hit, hit, hit
    edge = np.concatenate([[True], (owner[hit][1:] != owner[hit][:-1]) | (place[hit][1:] != place[hit][:-1] + 1)])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(hit)) - 1
    return owner[hit][first], place[hit][first], place[hit][last] + 1


def _count(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "minimiser"):
            start = table.column("start").to_numpy()
            digest = table.column("digest").to_pylist()
            ids = table.column("id").to_numpy()
            row, first, last = repeated_windows(table.column("packed").to_pylist(), ids, window)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[row], pa.int64()), pa.array([digest[r] for r in row], pa.string()),
                pa.array(start[row] + first, pa.int32()), pa.array(start[row] + last + window - 1, pa.int32()),
            ], names=["id", "digest", "first", "last"])

    return run


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        sizes, removed, digests, texts = [], [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = words_of(text)
            steps = np.zeros(len(words) + 1, np.int64)
            for span in spans:
                steps[span["first"]] += 1
                steps[span["last"]] -= 1
            kept = b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)])
            sizes.append(len(words))
            removed.append(int((np.cumsum(steps[:-1]) > 0).sum()))
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "text"],
        )


def deduplicate(docs: DataFrame, window: int = WINDOW, mer: int = MER, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(untouched, changed): digests of the documents that keep every word, and the others with their new ``text``.

    Untouched rows are (doc_id, n_words, kept_sha256); changed ones also have n_removed and the kept
    words joined by one space.
    """
    keyed = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long").alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text"
    )
    scanned = written(keyed.mapInArrow(_scan(window, mer), SCANNED), "substring-scan")
    parts = scanned.select("id", "digest", F.explode(F.arrays_zip("minimisers", "starts", "counts")).alias("p")).select(
        "id", "digest", F.col("p.minimisers").alias("minimiser"), F.col("p.starts").alias("start"), F.col("p.counts").alias("count")
    )
    shared = (
        parts.groupBy("minimiser").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where("least < most").select("minimiser")
    )
    by_doc = (
        parts.join(shared, "minimiser").groupBy(F.col("id").alias("of"), F.col("digest").alias("as"))
        .agg(F.collect_list(F.struct("minimiser", "start", "count")).alias("parts"))
    )
    candidates = written(
        keyed.join(by_doc.hint("shuffle_hash"), (F.col("id") == F.col("of")) & (F.col("digest") == F.col("as")))
        .select("id", "digest", "text", "parts"), "substring-candidates",
    )
    cut = written(candidates.mapInArrow(_cut(window), CUT).withColumn("mark", F.md5("packed")), "substring-cut")
    marks = cut.groupBy(F.col("mark").alias("m")).agg(F.min("id").alias("least"), F.max("id").alias("most"))
    copied = cut.select("mark", "id", "digest", "start", "count").join(marks.where("least < most"), F.col("mark") == F.col("m"))
    copied_spans = copied.where("id > least").select(
        "id", "digest", F.col("start").alias("first"), (F.col("start") + F.col("count") + window - 1).alias("last")
    )
    first = cut.join(marks.withColumnRenamed("least", "l"), (F.col("mark") == F.col("m")) & (F.col("id") == F.col("l")))
    first = written(first.select("minimiser", "id", "digest", "start", "packed"), "substring-first")
    busy = first.groupBy(F.col("minimiser").alias("b")).agg(F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most"))
    busy = written(busy.where("least < most").select("b", (F.col("n") > hot).alias("hot")), "substring-busy")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = first.join(small_side(busy), F.col("minimiser") == F.col("b")).select("minimiser", "id", "digest", "start", "packed", "hot")
    spans = met.where("not hot").repartition(tasks, "minimiser").sortWithinPartitions("minimiser").mapInArrow(
        _count(window), "id long, digest string, first int, last int"
    )
    single = met.where("hot").mapInArrow(_windows(window), SINGLE)
    least = single.groupBy(F.col("high").alias("h"), F.col("low").alias("l")).agg(F.min("id").alias("least"), F.max("id").alias("most"))
    hot_spans = (
        single.join(least.where("least < most"), (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")))
        .where("least < id").select("id", "digest", F.col("start").alias("first"), (F.col("start") + window).alias("last"))
    )
    removed = written(
        spans.union(hot_spans).union(copied_spans).groupBy(F.col("id").alias("of"), F.col("digest").alias("as"))
        .agg(F.collect_set(F.struct("first", "last")).alias("spans")), "substring-spans",
    )
    changed = (
        candidates.select("id", "digest", "text").join(removed, (F.col("id") == F.col("of")) & (F.col("digest") == F.col("as")))
        .select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "text", "spans").mapInArrow(_remove, RESULT)
    )
    untouched = scanned.join(
        small_side(removed.select("of", "as")), (F.col("id") == F.col("of")) & (F.col("digest") == F.col("as")), "left_anti"
    ).select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_words", "kept_sha256")
    return untouched, changed


def result(docs: DataFrame) -> DataFrame:
    """Words, removed words and the digest of the kept words of every document."""
    untouched, changed = deduplicate(docs.select("doc_id", "text"))
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return untouched.withColumn("n_removed", F.lit(0).cast("long")).select(columns).union(changed.select(columns))
