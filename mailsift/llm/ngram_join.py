"""N-gram Jaccard join by vertical partitioning.

All n-grams have one global order: rare ones first by their 64-bit hashes, then the common ones by
rising counts. Every document is counted for it; a task adds up what repeats and keeps its heaviest
counts, and the ``COMMON`` most frequent n-grams of all are named. The counts decide about work, never about links:
any one order gives the same ones.

1. *Prefixes.* Two sets that link share at least ``least_overlap`` n-grams, so in either the first shared
   one has no more n-grams before it than the set may lack. Documents with equal sets become one
   class first; only the prefix of a class is dealt out, by n-gram, and n-grams of one class end there. A row
   keeps its place, and a pair meets only where the places in both fit the two sizes.
2. *Groups of near copies.* Where more than ``HOT`` classes share an n-gram, each is first compared
   with the few classes that lead most of its n-grams: those in which one comes earliest, so that the
   original leads its edited copies. What links becomes one group.
3. *Candidates.* Only classes of different groups are paired, so a group's own pairs are never listed. Where an
   n-gram has more such pairs than rows that name its followers, it is dealt out with each follower instead: the
   pair meets at its first two. Of a candidate pair the parities of the sets' n-grams in ``BITS`` cells are
   compared: each that differs stands for an n-gram that one of them lacks, and pairs that lack too many are left.
4. *Overlaps.* The order's hash range is cut into fragments of some ``FRAGMENT`` n-grams of a set; each
   fragment counts the partial overlap of a pair apart, and the sums per pair decide about the link.

Defined results: words are what lies between ASCII white space; a text with fewer words than ``n``
has its whole sequence as its only n-gram; a text without words (or null) has an empty set and links
with nothing; rows with equal ids are rows of their own; null ids come last, and a component of null
ids only has a null id; an empty table gives none. Hashes stand for n-grams: with 64 bits the chance
that a set's size is off is below its size squared over 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.llm.common import (
    NO_ID, bounded_side, components, gram_hashes, scramble, small_side, text_slices, word_hashes, words_of, written,
)

COMMON = 1 << 18  # n-grams that are ordered by their counts; also the counts a task keeps
WAITING = 1 << 22  # n-grams that a task gathers before it adds up those that occur in them twice or more
LEAST_COUNT = 8  # a rarer n-gram is ordered by its hash
BITS = 512  # cells whose parities a class keeps
HOT = 8  # classes that share a key, beyond which they are first compared with its leaders
LEADERS = 3  # such comparisons for a class
FRAGMENT = 4096  # n-grams of a set in a fragment of the order, on average


def shingle_set(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles."""
    hashes = word_hashes(words)
    if 0 < len(words) < n:
        padded = np.concatenate([hashes, np.full(n - len(words), len(words), np.uint64)])
        return gram_hashes(padded, n)
    grams = gram_hashes(hashes, n)
    grams.sort()
    return grams[np.concatenate([[True], grams[1:] != grams[:-1]])] if len(grams) else grams


def heaviest(grams: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest counts, sorted by n-gram; equal n-grams are added up first."""
    grams, place = np.unique(grams, return_inverse=True)
    counts = np.bincount(place, counts, len(grams)).astype(np.int64)
    if len(grams) > most:
        top = np.sort(np.argpartition(-counts, most)[:most])
        grams, counts = grams[top], counts[top]
    return grams, counts


def repeated(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that occur more than once, sorted, and their counts."""
    grams = np.sort(grams)
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(grams)), bool), grams[1:] != grams[:-1]]))
    counts = np.diff(np.append(starts, len(grams)))
    return grams[starts[counts > 1]], counts[counts > 1]


def _count(n: int, lower: bool, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] = np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting: list[np.ndarray] = []

        def add_up() -> tuple[np.ndarray, np.ndarray]:
            new = repeated(np.concatenate([*waiting, np.empty(0, np.uint64)]))
            waiting.clear()
            return heaviest(*(np.concatenate(two) for two in zip(held, new)), most)

        for batch in text_slices(batches):
            waiting += [shingle_set(words_of(text, lower), n) for text in batch.column("text").to_pylist()]
            if sum(map(len, waiting)) > WAITING:
                held = add_up()
        grams, counts = add_up()
        yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts)], names=["gram", "count"])

    return run


def common_grams(docs: DataFrame, n: int, lower: bool, most: int = COMMON, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, sorted, and the place of each in the order of rising counts.

    At most ``most`` rows come to the driver, whatever the number of documents.
    """
    counted = docs.select("text").mapInArrow(_count(n, lower, most), "gram long, count long")
    top = (
        counted.groupBy("gram").agg(F.sum("count").alias("count")).where(F.col("count") >= least)
        .orderBy(F.desc("count"), "gram").limit(most).toArrow()
    )
    grams = top.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return grams[order], (len(grams) - 1 - np.arange(len(grams)))[order]


def ordered_prefix(grams: np.ndarray, early: int, length: int, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int, int]:
    """The first ``length`` n-grams of a sorted set in the global order, and numbers for the places of the ``early``-th and the last."""
    names, places = common
    at = np.searchsorted(names, grams)
    known = np.zeros(len(grams), bool)
    inside = at < len(names)
    known[inside] = names[at[inside]] == grams[inside]
    rare = grams[~known][:length]
    often = at[known]
    often = often[np.argsort(places[often])][: length - len(rare)]

    def place(i: int) -> int:
        return int(rare[i] >> np.uint64(2)) if i < len(rare) else (1 << 62) + int(places[often[i - len(rare)]])

    return np.concatenate([rare, names[often]]), place(early - 1), place(length - 1)


CELLS = [f"cell{i}" for i in range(BITS // 64)]
SIGNED = "id long, digest string, n long, one long, two long, " + "".join(f"{c} long, " for c in CELLS) + "prefix array<long>"


def prefix_length(size: int, numerator: int, denominator: int) -> int:
    return size - -(-numerator * size // denominator) + 1


def early_length(size: int, numerator: int, denominator: int) -> int:
    """Length of the prefix that meets every set that links and is at least as large."""
    return size - -(-2 * numerator * size // (numerator + denominator)) + 1


def parities(grams: np.ndarray) -> np.ndarray:
    """Whether the number of n-grams in each cell is odd, as words of 64 bits."""
    odd = np.bincount((grams & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sign(n: int, lower: bool, numerator: int, denominator: int, common: Broadcast):
    """Sizes, sums, parities and the prefix of every set, with one n-gram more to follow the last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sizes, ones, twos, cells, prefixes = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingle_set(words_of(text, lower), n)
                some = len(grams) > 0
                sizes.append(len(grams))
                ones.append(int(np.add.reduce(grams).astype(np.int64)) if some else 0)
                twos.append(int(np.add.reduce(scramble(grams + np.uint64(0x9E3779B97F4A7C15))).astype(np.int64)) if some else 0)
                cells.append(parities(grams))
                length = min(len(grams), prefix_length(len(grams), numerator, denominator) + 1)
                prefixes.append((ordered_prefix(grams, length, length, common.value)[0] if some else grams).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("digest"), *(pa.array(c, pa.int64()) for c in (sizes, ones, twos)),
                 *(pa.array(c) for c in np.ascontiguousarray(np.array(cells, np.int64).reshape(-1, len(CELLS)).T)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*prefixes, np.empty(0, np.int64)]), pa.int64()))],
                names=[x.split()[0] for x in SIGNED.split(", ")],
            )

    return run


SLICES = "number long, fragments long, fragment long, grams array<long>"


def _slices(n: int, lower: bool):
    """Every set cut into ``fragments`` ranges of hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            keys = zip(batch.column("number").to_pylist(), batch.column("fragments").to_pylist())
            for (number, fragments), text in zip(keys, batch.column("text").to_pylist()):
                grams = shingle_set(words_of(text, lower), n)
                place = ((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
                offsets = np.searchsorted(place, np.arange(fragments + 1, dtype=np.uint64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(fragments, number)), pa.array(np.full(fragments, fragments)), pa.array(np.arange(fragments)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams.view(np.int64)))],
                    names=["number", "fragments", "fragment", "grams"],
                )

    return run


def linked(pairs: DataFrame, classes: DataFrame, numbered: DataFrame, n: int, numerator: int, denominator: int, lower: bool) -> DataFrame:
    """The pairs (a, b) of classes that link, by partial overlaps in the fragments of the order, summed per pair."""
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("number").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in CELLS)), side)
    odd = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in CELLS), F.lit(0))
    lacking = F.col("na") + F.col("nb") - 2 * least_overlap("na", "nb", numerator, denominator)
    pairs = pairs.where(odd <= lacking).select("a", "b", "na", "nb")
    pairs = written(
        pairs.withColumn("fragments", F.ceil(F.greatest("na", "nb") / F.lit(FRAGMENT)).cast("long")), "ngram-pairs"
    )
    needed = pairs.select(F.col("a").alias("number"), "fragments").union(pairs.select("b", "fragments")).distinct()
    wanted = written(
        needed.join(classes.select("number", F.col("rep.id").alias("want"), F.col("rep.digest").alias("as")), "number"), "ngram-wanted"
    )
    texts = numbered.join(
        small_side(wanted).hint("shuffle_hash"), (F.col("id") == F.col("want")) & (F.col("digest") == F.col("as"))
    ).select("number", "fragments", "text").dropDuplicates(["number", "fragments"])
    slices = written(texts.mapInArrow(_slices(n, lower), SLICES), "ngram-slices")
    parts = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fragments") - 1)))
    for side in "ab":
        held = slices.select(F.col("number").alias(side), "fragments", "fragment", F.col("grams").alias(f"grams_{side}"))
        parts = parts.join(held, [side, "fragments", "fragment"])
    partial = F.size(F.array_intersect("grams_a", "grams_b")).cast("long")
    sums = parts.select("a", "b", "na", "nb", partial.alias("partial")).groupBy("a", "b", "na", "nb").agg(F.sum("partial").alias("both"))
    return written(
        sums.where(denominator * F.col("both") >= numerator * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"), "ngram-links"
    )


def least_overlap(na: str, nb: str, numerator: int, denominator: int) -> Column:
    """What two sets of these sizes share at least if they link."""
    return F.ceil(F.lit(numerator) * (F.col(na) + F.col(nb)) / F.lit(numerator + denominator) - 1e-9)


def may_link(at: tuple[str, str], sizes: tuple[str, str], numerator: int, denominator: int) -> Column:
    """Whether sizes and the places of the first shared n-gram leave the threshold within reach."""
    near = lambda small, large: denominator * F.col(small) >= numerator * F.col(large)
    least = least_overlap(*sizes, numerator, denominator)
    return near(*sizes) & near(*sizes[::-1]) & (F.col(at[0]) <= F.col(sizes[0]) - least) & (F.col(at[1]) <= F.col(sizes[1]) - least)


def opened_prefixes(own: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """A row for every n-gram of a prefix, with its place; the whole prefix goes with it."""
    length = F.col("n") - F.ceil(F.lit(numerator) * F.col("n") / F.lit(denominator) - 1e-9) + 1
    return own.select("number", "n", "prefix", F.posexplode("prefix").alias("at", "gram")).where(F.col("at") < length)


def postings_of(own: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(gram, number, n, at, behind): n-grams in the prefixes of several classes, and how many follow them there."""
    opened = opened_prefixes(own, numerator, denominator)
    shared = written(opened.groupBy("gram").agg(F.count("*").alias("many")).where("many > 1").select("gram"), "ngram-shared")
    rows = opened.select("gram", "number", "n", "at", (F.size("prefix") - F.col("at") - 1).alias("behind"))
    return written(rows.join(bounded_side(shared), "gram"), "ngram-postings")


def grouped_keys(own: DataFrame, postings: DataFrame, groups: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(gram, second, number, n, at, component): keys that classes of several groups share.

    ``second`` is 0 where an n-gram stands alone. Otherwise it is one that follows, and ``at`` the place before
    its own: a pair lacks no more before its second shared n-gram than before its first. Sets that may link by
    sharing one n-gram alone keep the 0 as well. Only pairs of different groups are counted against the followers,
    so the n-grams of a large group of near copies are not dealt out with theirs.
    """
    found = groups.select(F.col("id").alias("number"), "component")
    with_group = lambda rows: rows.join(found, "number", "left").withColumn("component", F.coalesce("component", "number"))
    grouped = with_group(postings)
    held = grouped.groupBy("gram", "component").agg(F.count("*").alias("many"), F.sum("behind").alias("behind"))
    same = F.sum(F.col("many") * F.col("many"))
    met = written(
        held.groupBy("gram").agg(
            F.count("*").alias("groups"), ((F.sum("many") * F.sum("many") - same) / 2 > F.sum("behind")).alias("followed")
        ).where("groups > 1").select("gram", "followed"), "ngram-met",
    )
    alone = grouped.join(bounded_side(met), "gram").where(~F.col("followed") | (numerator * F.col("n") <= denominator)).select(
        "gram", F.lit(0).cast("long").alias("second"), "number", "n", "at", "component"
    )
    # The frequent n-grams are few: where they are short enough to be broadcast, no prefix is moved.
    rest = F.slice("prefix", F.col("at") + 2, F.size("prefix"))
    two = written(
        with_group(
            opened_prefixes(own, numerator, denominator).join(bounded_side(met.where("followed").select("gram")), "gram")
            .select("gram", "number", "n", "at", F.posexplode(rest).alias("further", "second"))
            .select("gram", "second", "number", "n", (F.col("at") + F.col("further")).alias("at"))
        ).select("gram", "second", "number", "n", "at", "component"), "ngram-followed",
    )
    several = two.groupBy("gram", "second").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("gram", "second")
    return written(alone.unionByName(two.join(several, ["gram", "second"])), "ngram-grouped")


def led_pairs(postings: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """In n-grams of more than ``HOT`` classes: each class with the classes that lead most of its own."""
    leaders = postings.groupBy("gram").agg(
        F.count("*").alias("many"), F.min(F.struct("at", "number", "n")).alias("led")
    ).where(F.col("many") > HOT).select("gram", F.col("led.number").alias("a"), F.col("led.at").alias("at_a"), F.col("led.n").alias("na"))
    votes = (
        postings.join(leaders, "gram").where(F.col("number") != F.col("a"))
        .where(may_link(("at_a", "at"), ("na", "n"), numerator, denominator))
        .groupBy("a", "na", "number", "n").agg(F.count("*").alias("votes"))
    )
    best = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("votes"), "a"))
    return votes.withColumn("best", best).where(F.col("best") <= LEADERS).select("a", F.col("number").alias("b"), "na", F.col("n").alias("nb"))


def candidate_pairs(grouped: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs of classes of different groups that meet where their sizes allow it."""
    key = ["gram", "second"]
    several = grouped.groupBy(*key, "component").agg(F.max("n").alias("most"), F.min("n").alias("least"), F.min("at").alias("first"))
    left, right = (several.select(*key, *(F.col(c).alias(f"{c}_{s}") for c in ("component", "most", "least", "first"))) for s in "ab")
    near = lambda small, large: denominator * F.col(small) >= numerator * F.col(large)

    def fits(at: str, own: str, other: str) -> Column:
        """Whether a place may be that of the first shared n-gram, for a set of at most one size and another of at least one."""
        return F.lit(numerator + denominator) * F.col(at) <= denominator * F.col(own) - numerator * F.col(other)

    met = left.join(right, key).where(
        (F.col("component_a") < F.col("component_b")) & near("most_a", "least_b") & near("most_b", "least_a")
        & fits("first_a", "most_a", "least_b") & fits("first_b", "most_b", "least_a")
    ).select(*key, "component_a", "component_b", "least_b")
    for s in "ab":
        own = grouped.select(*key, F.col("component").alias(f"component_{s}"), F.col("number").alias(s), F.col("n").alias(f"n{s}"), F.col("at").alias(f"at_{s}"))
        allowed = fits("at_a", "na", "least_b") if s == "a" else may_link(("at_a", "at_b"), ("na", "nb"), numerator, denominator)
        met = met.join(own, [*key, f"component_{s}"]).where(allowed)
    return met.select("a", "b", "na", "nb").distinct()


def join(docs: DataFrame, n: int = 5, numerator: int = 8, denominator: int = 10, lower: bool = True) -> DataFrame:
    """(id, digest, n_shingles, component_id, first_digest): a row for every row of ``docs``.

    Two documents link when ``denominator * intersection >= numerator * union`` of their sets of
    ``n``-word shingles. ``id`` is doc_id (null: ``NO_ID``) and ``digest`` the MD5 of the text;
    ``component_id`` and ``first_digest`` name the first document of the component. No link is lost.
    """
    numbered = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long").alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"),
        F.col("text"),
    )
    common = docs.sparkSession.sparkContext.broadcast(common_grams(docs, n, lower))
    signed = written(
        numbered.mapInArrow(_sign(n, lower, numerator, denominator, common), SIGNED).withColumn("cls", F.xxhash64("n", "one", "two"))
        .withColumn("row", F.monotonically_increasing_id()), "ngram-signed",
    )
    equal = ["cls", "n", "one", "two"]
    classes = written(
        signed.where("n > 0").groupBy(*equal).agg(
            F.min(F.struct("id", "digest", "row")).alias("rep"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in CELLS)
        ).withColumn("number", F.col("rep.row")).withColumn("rep", F.struct("rep.id", "rep.digest")), "ngram-classes",
    )
    # Of copies only the first row's prefix is dealt out; sets without copies are their own first rows.
    copied = classes.where("copies > 1").select(*equal, "number")
    own = signed.where("n > 0").join(bounded_side(copied), equal, "left").where("number is null or number = row")
    own = own.select(F.col("row").alias("number"), "n", "prefix")
    postings = postings_of(own, numerator, denominator)
    find = lambda pairs: linked(pairs, classes, numbered, n, numerator, denominator, lower)
    links = find(led_pairs(postings, numerator, denominator))
    grouped = grouped_keys(own, postings, components(links), numerator, denominator)
    links = links.union(find(candidate_pairs(grouped, numerator, denominator)))
    joined = components(links).withColumnRenamed("id", "linked")
    located = classes.join(joined, F.col("number") == F.col("linked"), "left").withColumn("component", F.coalesce("component", "number"))
    first = located.groupBy("component").agg(F.min("rep").alias("first"))
    named = located.join(first, "component").select(
        F.col("n").alias("_n"), F.col("one").alias("_one"), F.col("two").alias("_two"), "first"
    )
    full = signed.join(
        named, (F.col("n") == F.col("_n")) & (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")), "left"
    )
    return full.select(
        "id", "digest", F.col("n").alias("n_shingles"), F.coalesce("first.id", "id").alias("component_id"),
        F.coalesce("first.digest", "digest").alias("first_digest"),
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of each component: its first in the order of id and text digest; columns unchanged."""
    kept = written(
        join(docs.select("doc_id", "text"), **options).where((F.col("id") == F.col("component_id")) & (F.col("digest") == F.col("first_digest")))
        .groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest")).agg(F.count("*").alias("_copies")), "ngram-kept",
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long").alias("id"),
        F.md5(F.coalesce("text", F.lit(""))).alias("digest"),
    )
    rows = rows.join(small_side(kept).hint("shuffle_hash"), (F.col("id") == F.col("_id")) & (F.col("digest") == F.col("_digest")))
    if kept.where("_copies > 1").limit(1).count():  # rows repeated with their id: one of them stays
        rows = rows.dropDuplicates(["id", "digest"])
    return rows.select("row.*")


def result(docs: DataFrame) -> DataFrame:
    """The set size and component of every document: three words, nine tenths."""
    joined = join(docs.select("doc_id", "text"), n=3, numerator=90, denominator=100)
    real = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return joined.select(real("id").alias("doc_id"), "n_shingles", real("component_id").alias("component_id"))
