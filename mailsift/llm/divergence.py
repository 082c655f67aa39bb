"""How far the sources of a language differ in their words, by a frequent-pattern tree of term rows.

A row holds one term's nonzero counts in the order of the sources. Two sources are compared term by
term, but most terms are absent from most sources, so the sum over all terms is taken as

    V * f(both absent) + (corrections where only one is present) + (corrections where both are)

The corrections of a single source come from a histogram of its counts. Those of two sources come
from the tree: equal rows become one row with a multiplicity, rows are range-sorted, so that rows
sharing a path are neighbours, and every task walks its stretch of the sorted rows as a prefix tree.
A node (source, count) with ``m`` terms below it adds its correction with each of its ancestors once,
times ``m``. Stretches are cut without regard to paths: a node cut in two adds the same in two parts.

Words are counted in Python, per task and group, and flushed when the counts grow; one shuffle by
(lang, term) then holds all that a term needs. A row has as many entries as its language has sources
with the term, and the result has a row for every pair of sources of a language, so sources are
meant to be few thousands at most.

Defined results: null text, lang and source are read as ''; every input row is a document of its
own, repeated or not; a group without terms counts 0 of every kept term; a language that keeps no
term has pairs of value 0; a group that is alone in its language has no pairs; an empty table gives
no rows. Values are exact: products that may leave 64 bits are decimals.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.llm.common import bounded_side, text_slices, written

LEAST_DOCUMENTS = 10  # a language keeps the terms of at least so many of its documents
SCALE = 1_000_000_000  # probabilities are counted in parts of this
TOP_TERMS = 10
FLUSH = 200_000  # counts that a task holds before it sends them on
PIECE = 4_000_000  # bytes of one text that are cut into words at once
MARK = b""  # the "term" that stands for the group itself
LETTERS = bytes(b if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
TO_TERMS = LETTERS.translate(bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)))

COUNTS = "lang string, source string, term binary, n long, d long"
PAIRS = "lang string, a string, b string, value long"


def term_pieces(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in pieces of bounded length that never cut a term."""
    data, start = (text or b"").translate(TO_TERMS), 0
    while start < len(data):
        stop = start + PIECE
        if stop < len(data):
            stop = data.find(b" ", stop)
            stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents), summed as long as the counts fit."""
    counts: dict = defaultdict(lambda: (Counter(), Counter()))

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in counts.items():
            terms = list(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()),
                 pa.array([n[t] for t in terms], pa.int64()), pa.array([d[t] for t in terms], pa.int64())],
                names=["lang", "source", "term", "n", "d"],
            )
        counts.clear()

    for piece in text_slices(batches):
        texts = piece.column("text").cast(pa.binary()).to_pylist()
        for lang, source, text in zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), texts):
            n, d = counts[lang, source]
            own: set[bytes] = set()
            for terms in term_pieces(text):
                n.update(terms)
                own.update(terms)
            d.update(own)
            d[MARK] += 0
        if sum(len(d) for _, d in counts.values()) > FLUSH:
            yield from flush()
    yield from flush()


def term_rows(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, items): each kept term's counts by source, in the order of the sources.

    One more row per language has the empty term, which no text holds; its items list all sources.
    """
    named = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    counts = named.mapInArrow(_count_terms, COUNTS).repartition("lang", "term")
    by_source = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    rows = by_source.groupBy("lang", "term").agg(
        F.sum("d").alias("documents"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("items")
    )
    return rows.where((F.col("documents") >= least) | (F.col("term") == F.lit(MARK))).select("lang", "term", "total", "items")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exactly."""
    wide = "decimal(19,0)"
    part = F.call_function("div", (count + 2).cast(wide) * F.lit(SCALE).cast("decimal(10,0)"), (total + F.lit(2) * terms).cast(wide))
    return F.when(terms > 0, F.lit(1) + part)


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares; the square of 1e9 is within a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def groups_of(rows: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total, none): every group and the share of a term that it lacks."""
    items = rows.select("lang", F.explode("items").alias("i")).groupBy("lang", F.col("i.source").alias("source"))
    totals = items.agg(F.sum("i.n").alias("total"))
    kept = rows.groupBy("lang").agg(F.sum((F.col("term") != F.lit(MARK)).cast("long")).alias("terms"), F.sum("total").alias("lang_total"))
    return totals.join(kept, "lang").withColumn("none", share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))


def entries_of(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, term, source, n, p, none, q): every nonzero count with its share and its language's."""
    opened = rows.where(F.col("term") != F.lit(MARK)).select("lang", "term", F.col("total").alias("_n"), F.explode("items").alias("i"))
    opened = opened.select("lang", "term", "_n", F.col("i.source").alias("source"), F.col("i.n").alias("n"))
    return opened.join(bounded_side(groups), ["lang", "source"]).select(
        "lang", "term", "source", "n", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "none",
        share(F.col("_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def tree_corrections(lang: np.ndarray, starts: np.ndarray, source: np.ndarray, n: np.ndarray, p: np.ndarray, none: np.ndarray, times: np.ndarray):
    """Yield (source a, source b, value): node-ancestor corrections of sorted rows, arrays over all nodes.

    Row ``i`` has the items ``starts[i]:starts[i + 1]``, in the order of the sources, and stands for
    ``times[i]`` terms. Rows come sorted, so a node is the first row of the run that shares its path.
    """
    size = np.diff(starts)
    row = np.repeat(np.arange(len(size)), size)
    depth = np.arange(len(row)) - starts[row]
    above = np.where((row > 0) & (depth < size[row - 1]) & (lang[row] == lang[row - 1]), starts[row - 1] + depth, -1)
    same = (above >= 0) & (source[above] == source) & (n[above] == n)
    shared = np.minimum.reduceat(np.where(same, size[row], depth), starts[:-1])  # length of the path kept from the row above
    node = np.flatnonzero(depth >= shared[row])
    until, below = np.empty(len(node), np.int64), np.concatenate([[0], np.cumsum(times)])
    at = depth[node]
    for level in range(int(at.max()) + 1):
        here = np.flatnonzero(at == level)
        ends = np.append(np.flatnonzero(shared <= level), len(size))
        until[here] = ends[np.searchsorted(ends, row[node[here]], "right")]
    terms = below[until] - below[row[node]]
    for up in range(1, int(at.max()) + 1):
        deep = np.flatnonzero(at >= up)
        low, high = node[deep], node[deep] - up
        value = _f(p[low], p[high]) - _f(p[low], none[high]) - _f(none[low], p[high]) + _f(none[low], none[high])
        yield source[high], source[low], value * terms[deep]


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The corrections of both sources over each batch of sorted rows, summed by pair."""
    for batch in batches:
        if not batch.num_rows:
            continue
        items = batch.column("items")
        starts = items.offsets.to_numpy().astype(np.int64)
        flat = items.values.slice(int(starts[0]), int(starts[-1] - starts[0]))
        starts = starts - starts[0]
        names, langs = flat.field("source").dictionary_encode(), batch.column("lang").dictionary_encode()
        source, lang = names.indices.to_numpy().astype(np.int64), langs.indices.to_numpy().astype(np.int64)
        width = len(names.dictionary)
        coded = np.repeat(lang, np.diff(starts)) * width + source  # the same source of two languages is two sources
        sums: dict[int, int] = {}
        fields = [flat.field(c).to_numpy() for c in ("n", "p", "none")]
        total = width * len(langs.dictionary)
        for a, b, value in tree_corrections(lang, starts, coded, *fields, batch.column("times").to_numpy()):
            keys, where = np.unique(a * total + b, return_inverse=True)
            part = np.zeros(len(keys), np.int64)
            np.add.at(part, where, value)
            for key, v in zip(keys.tolist(), part.tolist()):
                sums[key] = sums.get(key, 0) + v
        high, low = np.divmod(np.fromiter(sums, np.int64, len(sums)), total)
        yield pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array(high // width)), names.dictionary.take(pa.array(high % width)),
             names.dictionary.take(pa.array(low % width)), pa.array(list(sums.values()), pa.int64())],
            names=["lang", "a", "b", "value"],
        )


def pair_values(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of two sources of a language."""
    item = F.struct("source", "n", "p", "none")
    rows = entries.groupBy("lang", "term").agg(F.sort_array(F.collect_list(item)).alias("items"))
    rows = rows.where(F.size("items") > 1).groupBy("lang", "items").agg(F.count("*").alias("times"))
    both = rows.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items").mapInArrow(_walk, PAIRS)
    other = bounded_side(groups.select("lang", F.col("source").alias("b"), F.col("none").alias("other")))
    found = entries.groupBy("lang", F.col("source").alias("a"), "p", "none").agg(F.count("*").alias("times"))
    single = found.join(other, "lang").where("a <> b").select(
        "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        (F.col("times") * (distance(F.col("p"), F.col("other")) - distance(F.col("none"), F.col("other")))).alias("value"),
    )
    mine = groups.select("lang", F.col("source").alias("a"), "none", "terms")
    base = mine.join(other, "lang").where("a < b").select(
        "lang", "a", "b", F.coalesce(F.col("terms") * distance(F.col("none"), F.col("other")), F.lit(0).cast("long")).alias("value")
    )
    summed = base.union(single).union(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return summed.select("lang", ways.alias("w"), "value").select("lang", "w.*", "value")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by distance, and the terms a source has more of."""
    rows = written(term_rows(docs, least), "audit-rows")
    groups = written(groups_of(rows), "audit-groups")
    entries = written(entries_of(rows, groups), "audit-entries")
    terms = entries.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), distance(F.col("p"), F.col("q")).alias("value")
    )
    pairs = pair_values(entries, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, terms)]
    return ranked[0].union(ranked[1].where(F.col("rank") <= top))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), w AS (SELECT id, lang, source, unnest(words) AS term FROM d),
c AS (SELECT id, lang, source, term, count(*) AS n FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING count(*) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT g.lang, g.source, k.term, k.n AS lang_n FROM g JOIN k USING (lang)),
n AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL),
y AS (SELECT x.*, coalesce(n.n, 0)::HUGEINT AS n FROM x LEFT JOIN n USING (lang, source, term)),
t AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source)::HUGEINT AS total, sum(n) OVER (PARTITION BY lang)::HUGEINT AS lang_total,
    count(*) OVER (PARTITION BY lang, source)::HUGEINT AS v FROM y
), p AS (
  SELECT *, 1 + 1000000000::HUGEINT * (n + 2) // (total + 2 * v) AS p, 1 + 1000000000::HUGEINT * (lang_n + 2) // (lang_total + 2 * v) AS q FROM t
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM r
) WHERE part = 'pair' OR rank <= 10
"""


def result(docs: DataFrame) -> DataFrame:
    return audit(docs.select("lang", "source", "text"))
