"""Mixing sources to target weights by weighted sampling without replacement (native).

Every document gets an exponential key ``-ln(u) / w`` from a hash of its id and its quality
weight ``w``: in the order of these keys, a prefix is a weighted sample without replacement. A
source whose target is ``e`` times its size and a rest gives ``e`` complete epochs first and then
the prefix of its keys that fills the rest.

No source is ever sorted as a whole. Keys fall into fixed bins; the sizes per (source, bin) combine
before the shuffle, prefix sums over the bins of a source find the one bin that holds the cut, and
only the rows of that bin are ranked. The text is read by map tasks and moved by no shuffle as long
as the per-source table is short; a longer one is joined by an ordinary join.

Defined results: null text has no words; a null source is a source of its own, the last in order;
null ids share one key; rows equal in id and text are taken together; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.llm.common import small_side, word_count, written

SOURCE_WEIGHTS = (3, 1, 2)  # by rank of the source, repeating
SHARE = 1.5  # words of the mix for each word of the input
LIMIT = 2  # a source gives at most this many times its words
BINS = 4096
NOISE = "#$%&*!|"  # the more of these in a text, the lower its quality


def quality(text: Column) -> Column:
    """Weight in (0, 1]: one over one plus twenty times the share of noise characters."""
    text = F.coalesce(text, F.lit(""))
    noise = F.length(text) - F.length(F.translate(text, NOISE, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * noise / F.greatest(F.length(text), F.lit(1)))


def sampling_key(key: Column, weight: Column) -> Column:
    """Exponential key: the hash of ``key`` as a uniform number, its logarithm over the weight."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")
    return -F.log((digits + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def source_targets(sources: DataFrame, weights=SOURCE_WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """Add ``target`` to (source, source_size): shares by weight, capped, the excess reshared.

    Sources in the order of (cap / weight) are capped from the smallest on, as long as the level
    that the rest would reach lies above their cap. One task orders the sources, a row each.
    """
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights)) + 1).cast("double")
    rows = sources.withColumns({"_w": weight, "_cap": F.col("source_size").cast("double") * limit})
    every = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("_cap") / F.col("_w"), F.asc_nulls_last("source")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0.0)
    rows = rows.withColumns({
        "_total": F.sum(F.col("source_size").cast("double")).over(every) * share,
        "_used": F.coalesce(F.sum("_cap").over(before), zero),
        "_left": F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), zero),
    })
    rows = rows.withColumn("_full", F.col("_cap") * F.col("_left") <= F.col("_w") * (F.col("_total") - F.col("_used")))
    level = rows.withColumns({
        "_capped": F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(every), zero),
        "_open": F.sum(F.when(~F.col("_full"), F.col("_w"))).over(every),
    })
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(
        F.col("_w") * (F.col("_total") - F.col("_capped")) / F.col("_open")
    )
    return level.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weight: Column | None = None, weights=SOURCE_WEIGHTS, share: float = SHARE, limit: int = LIMIT,
    bins: int = BINS,
) -> DataFrame:
    """(row, mix): every row of ``docs`` as a struct, and its size, source_size, target, copies and taken."""
    weight = quality(F.col("text")) if weight is None else weight
    key = sampling_key(F.col("doc_id"), weight)
    own = F.struct(
        word_count(F.col("text")).alias("size"), key.alias("key"),
        F.floor(F.lit(bins) * (key / (key + F.lit(1.0)))).cast("int").alias("bin"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("digest"),
    )
    narrow = written(docs.select("doc_id", "source", own.alias("m")).select("doc_id", "source", "m.*"), "mix-keys")
    by_bin = written(narrow.groupBy("source", "bin").agg(F.sum("size").alias("size")), "mix-bins")
    targets = source_targets(by_bin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    size = F.col("source_size")
    targets = targets.withColumn("epochs", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int"))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * size)
    targets = written(targets.withColumnRenamed("source", "_source"), "mix-targets")
    up_to = Window.partitionBy("source").orderBy("bin")
    filled = (
        by_bin.join(small_side(targets), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_until", F.sum("size").over(up_to)).where(F.col("_until") > F.col("rest"))
        .groupBy(F.col("source").alias("_filled"))
        .agg(F.min(F.struct("bin", (F.col("_until") - F.col("size")).alias("before"))).alias("cut"))
    )
    plan = written(
        targets.join(filled, F.col("_source").eqNullSafe(F.col("_filled")), "left").select(
            "_source", "source_size", "target", "epochs", "rest",
            F.coalesce("cut.bin", F.lit(bins)).alias("cut_bin"), F.col("cut.before").alias("before"),
        ), "mix-plan",
    )
    short = small_side(plan)
    at_cut = narrow.join(
        short, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("cut_bin"))
    ).groupBy("_source", "before", "rest", "key", "doc_id", "digest").agg(F.sum("size").alias("size"))
    order = Window.partitionBy("_source").orderBy("key", F.asc_nulls_last("doc_id"), "digest")
    before = F.col("before") + F.sum("size").over(order) - F.col("size")
    chosen = written(
        at_cut.withColumn("_before", before).where(F.lit(2) * F.col("_before") + F.col("size") <= F.lit(2) * F.col("rest"))
        .select(F.col("_source").alias("_cs"), F.col("doc_id").alias("_ci"), F.col("digest").alias("_cd")), "mix-chosen",
    )
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), F.col("source").alias("_of"), own.alias("_own"))
    rows = rows.join(short, F.col("_of").eqNullSafe(F.col("_source")))
    rows = rows.join(
        small_side(chosen),
        F.col("_of").eqNullSafe(F.col("_cs")) & F.col("_id").eqNullSafe(F.col("_ci"))
        & (F.col("_own.digest") == F.col("_cd")) & (F.col("_own.bin") == F.col("cut_bin")), "left",
    )
    picked = (F.col("_own.bin") < F.col("cut_bin")) | F.col("_cd").isNotNull()
    copies = F.col("epochs") + picked.cast("int")
    return rows.select("row", F.struct(
        F.col("_own.size").alias("size"), F.col("source_size").cast("long").alias("source_size"), "target",
        copies.alias("copies"), (F.col("_own.size") * copies).cast("long").alias("taken"),
    ).alias("mix"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, columns unchanged."""
    mixed = mix(docs, **options).where(F.col("mix.copies") > 0)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("mix.copies")))).select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), k AS (
  SELECT doc_id, source, size, md5(text) AS digest,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5e0) / 4503599627370496e0)
      / (1e0 / (1e0 + 20e0 * (length(text) - length(translate(text, '#$%&*!|', ''))) / greatest(length(text), 1))) AS key
  FROM d
), s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
    [3e0, 1e0, 2e0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS w FROM k GROUP BY source
), f AS (
  SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 1.5e0 AS total, sum(w) OVER () AS ws FROM s
), g AS (
  SELECT *, coalesce(sum(cap) OVER b, 0e0) AS used, ws - coalesce(sum(w) OVER b, 0e0) AS rest_w FROM f
  WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), h AS (SELECT *, cap * rest_w <= w * (total - used) AS fully FROM g),
t AS (
  SELECT source, source_size, CASE WHEN fully THEN cap ELSE
    w * (total - coalesce(sum(cap) FILTER (WHERE fully) OVER (), 0e0)) / sum(w) FILTER (WHERE NOT fully) OVER () END AS target FROM h
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t
), u AS (
  SELECT source, doc_id, digest, key, sum(size)::BIGINT AS unit FROM k GROUP BY ALL
), p AS (
  SELECT *, sum(unit) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, digest ROWS UNBOUNDED PRECEDING) - unit AS before FROM u
)
SELECT k.doc_id, k.size, e.source_size::BIGINT AS source_size, e.target,
  (k.size * (e.epochs + (2 * p.before + p.unit <= 2 * (e.target - e.epochs * e.source_size))::INT))::BIGINT AS taken
FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
JOIN p ON k.source IS NOT DISTINCT FROM p.source AND k.doc_id IS NOT DISTINCT FROM p.doc_id AND k.digest = p.digest
"""


def result(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document."""
    mixed = mix(docs.select("doc_id", "source", "text"))
    return mixed.select("row.doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")
