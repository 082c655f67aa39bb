"""Curation: filter, deduplicate, exact samples, leakage-safe splits, funnel counts."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.config import MAX_TEMP_SHARE, SEED, SPLIT_SIZES
from mailsift.functions.text import hash32
from mailsift.session import written

HASH_BUCKETS_SHIFT = 16  # the top 16 of 32 hash bits: 65,536 even buckets


def drop_corrupted(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_corrupted"))


def deduplicate(
    df: DataFrame, group: str = "duplicate_group", order: tuple[str, ...] = ("source_dataset", "email_id")
) -> DataFrame:
    """The first row of every group in ``order``; of rows that are equal in it, any one.

    Winners are found on the narrow columns (group, order) alone and written; the whole rows are then
    fetched by one semi-join on all of these, so a body shared by a third of all rows meets in no
    task. Nulls are values. Rows repeated in group and order are made one among themselves.
    """
    names = list(dict.fromkeys((group, *order)))
    seen = df.groupBy(*names).agg(F.count("*").alias("_rows"))
    first = seen.groupBy(group).agg(F.min_by(F.struct(*names, "_rows"), F.struct(*order)).alias("_first"))
    winners = written(first.select("_first.*"), "winners")

    def rows_of(chosen: DataFrame) -> DataFrame:
        renamed = chosen.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(names)])
        same = [F.col(c).eqNullSafe(F.col(f"_w{i}")) for i, c in enumerate(names)]
        return df.join(renamed, reduce(Column.__and__, same), "left_semi")

    if winners.filter("_rows > 1").isEmpty():
        return rows_of(winners)
    return rows_of(winners.filter("_rows = 1")).union(rows_of(winners.filter("_rows > 1")).dropDuplicates([group]))


# ---- exact cuts in seeded hash order ---------------------------------------------------


def _boundaries(df: DataFrame, stratum: str, key: str, cuts: Mapping, seed: int | str) -> DataFrame:
    """Per stratum, the (hash, key) of the last row of every slice, at most one row per slice.

    ``cuts`` maps stratum -> [(slice, rows up to and including this slice)]. A count per hash
    bucket finds the bucket that holds each cut; only the rows of those few buckets are
    ranked, so nothing is sorted as a whole and no stratum meets in one task.
    """
    spark = df.sparkSession
    rows = [
        (value, name, place, int(upto))
        for value, slices in cuts.items()
        for place, (name, upto) in enumerate(slices)
    ]
    wanted = spark.createDataFrame(rows, f"_stratum {df.schema[stratum].dataType.simpleString()}, slice string, place int, upto long")
    hashed = df.select(
        F.col(stratum).alias("_stratum"), F.col(key).cast("string").alias("_key"), hash32(seed, F.col(key)).alias("_hash")
    ).withColumn("_bucket", F.shiftright("_hash", HASH_BUCKETS_SHIFT))
    running = Window.partitionBy("_stratum").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = hashed.groupBy("_stratum", "_bucket").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(running), F.lit(0))
    )
    cut_buckets = buckets.join(F.broadcast(wanted), "_stratum").filter(
        (F.col("_before") < F.col("upto")) & (F.col("upto") <= F.col("_before") + F.col("_n"))
    )
    in_bucket = Window.partitionBy("_stratum", "slice").orderBy("_hash", "_key")
    return (
        hashed.join(F.broadcast(cut_buckets.drop("_n")), ["_stratum", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.row_number().over(in_bucket))
        .filter(F.col("_rank") == F.col("upto"))
        .select("_stratum", "slice", "place", "_hash", "_key")
    )


def apply_boundaries(
    df: DataFrame, bounds: DataFrame, stratum: str, key: str, seed: int | str, out: str, rest: str | None = None
) -> DataFrame:
    """Name the slice of every row; rows beyond the last slice get ``rest``.

    The rows never move: each is compared with the broadcast boundaries, whose number is
    strata times slices. Rows that share a key share a slice.
    """
    per_stratum = bounds.groupBy(F.col("_stratum").alias(stratum)).agg(
        F.sort_array(F.collect_list(F.struct("place", "slice", "_hash", "_key"))).alias("_cuts")
    )
    joined = df.withColumn("_h", hash32(seed, F.col(key))).join(F.broadcast(per_stratum), stratum, "left")
    own_key = F.col(key).cast("string")
    passed = F.filter(
        "_cuts",
        lambda c: (F.col("_h") < c["_hash"]) | ((F.col("_h") == c["_hash"]) & (own_key <= c["_key"])),
    )
    chosen = F.try_element_at(passed, F.lit(1))["slice"]
    return joined.withColumn(out, F.coalesce(chosen, F.lit(rest))).select(*df.columns, out)


def class_counts(df: DataFrame, label: str = "label") -> dict:
    """Rows per class on the driver: as many entries as there are classes."""
    return {row[0]: row[1] for row in df.groupBy(label).count().collect()}


def sample_classes(df: DataFrame, sizes: Mapping[int, int], seed: int = SEED, key: str = "email_id") -> DataFrame:
    """Exactly ``sizes[label]`` rows per class without replacement; an error if a class is short.

    Rows that share a key would share their fate and spoil the sizes, so repeated keys are an error.
    """
    counts = class_counts(df)
    repeated = df.filter(F.col("label").isin(*sizes)).groupBy("label", key).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{key} {repeated[0][key]!r} is repeated: an exact sample needs unique keys.")
    short = {label: counts.get(label, 0) for label, size in sizes.items() if counts.get(label, 0) < size}
    if short:
        raise ValueError(f"Not enough rows per class: wanted {dict(sizes)}, found {short}.")
    cuts = {label: [("sample", size)] for label, size in sizes.items()}
    kept = df.filter(F.col("label").isin(*sizes))
    bounds = _boundaries(kept, "label", key, cuts, f"sample-{seed}")
    named = apply_boundaries(kept, bounds, "label", key, f"sample-{seed}", "_slice")
    return named.filter("_slice = 'sample'").drop("_slice")


def stratified_folds(df: DataFrame, folds: int, seed: int = SEED, key: str = "email_id", out: str = "_fold") -> DataFrame:
    """Rows with their fold, 0 to ``folds`` - 1: every class is cut into folds of equal size, to one row.

    Rows that share a key share a fold. A class with fewer rows than folds is an error.
    """
    counts = class_counts(df)
    short = {label: n for label, n in counts.items() if n < folds}
    if short:
        raise ValueError(f"Classes with fewer rows than {folds} folds: {short}.")
    cuts = {label: [(str(i), n * (i + 1) // folds) for i in range(folds)] for label, n in counts.items()}
    bounds = _boundaries(df, "label", key, cuts, f"fold-{seed}")
    return apply_boundaries(df, bounds, "label", key, f"fold-{seed}", out).withColumn(out, F.col(out).cast("int"))


def shuffle_rows(df: DataFrame, seed: int = SEED, key: str = "email_id") -> DataFrame:
    """A seeded order as a range-partitioned sort; ask for it only where order is output."""
    return df.orderBy(hash32(f"shuffle-{seed}", F.col(key)), key)


# ---- splits ------------------------------------------------------------------------------


def with_group_key(df: DataFrame, source: str = "thread_group") -> DataFrame:
    return df.withColumn("group_key", F.col(source).cast("string"))


def group_labels(df: DataFrame) -> DataFrame:
    """One row per group with its label and whether its labels disagree."""
    return df.groupBy("group_key").agg(
        F.min("label").alias("label"), (F.min("label") != F.max("label")).alias("is_mixed"), F.count("*").alias("rows")
    )


def mixed_label_groups(df: DataFrame) -> DataFrame:
    return group_labels(df).filter("is_mixed").select("group_key", "rows")


def require_label_counts(df: DataFrame, expected: Mapping[int, int], at_least: int) -> None:
    """With ``at_least`` rows or more, the class sizes must be exactly ``expected``."""
    counts = class_counts(df)
    if sum(counts.values()) >= at_least and counts != dict(expected):
        raise ValueError(f"Expected class sizes {dict(expected)} before splitting, found {counts}.")


def require_split_sizes(df: DataFrame, expected: Mapping[str, int]) -> None:
    """With exactly the expected number of rows, every split must have its size."""
    counts = {row[0]: row[1] for row in df.groupBy("split").count().collect()}
    if sum(counts.values()) == sum(expected.values()) and counts != dict(expected):
        raise ValueError(f"Unexpected split sizes: {counts} instead of {dict(expected)}.")


def _proportional(counts: Mapping, total: int) -> dict:
    """``total`` shared out in proportion by largest remainder, ties to the smaller label."""
    whole = sum(counts.values())
    exact = {label: n / whole * total for label, n in counts.items()}
    share = {label: math.floor(value) for label, value in exact.items()}
    by_remainder = sorted(exact, key=lambda label: (share[label] - exact[label], label))
    for label in by_remainder[: total - sum(share.values())]:
        share[label] += 1
    return share


def split_quotas(counts: Mapping[int, int], sizes: Mapping[str, int] = SPLIT_SIZES) -> dict[int, dict[str, int]]:
    """Groups per label and split: a stratified temporary share, then halved into valid and test."""
    groups = sum(counts.values())
    temp_share = min(MAX_TEMP_SHARE, (sizes["valid"] + sizes["test"]) / groups)
    temp_total = math.ceil(temp_share * groups)
    train = _proportional(counts, groups - temp_total)
    temp = {label: n - train[label] for label, n in counts.items()}
    valid = _proportional(temp, temp_total - math.ceil(0.5 * temp_total))
    quotas = {
        label: {"train": train[label], "valid": valid[label], "test": temp[label] - valid[label]} for label in counts
    }
    if any(n < 2 for n in counts.values()) or any(
        sum(q[name] for q in quotas.values()) < len(counts) for name in ("train", "valid", "test")
    ):
        raise ValueError(f"Too few groups per label for a stratified split: {dict(counts)}.")
    return quotas


def split_boundaries(groups: DataFrame, seed: int = SEED, sizes: Mapping[str, int] = SPLIT_SIZES) -> DataFrame:
    """Cuts in (group_key, label) that give exact stratified split sizes."""
    quotas = split_quotas(class_counts(groups), sizes)
    cuts = {label: [("train", q["train"]), ("valid", q["train"] + q["valid"])] for label, q in quotas.items()}
    return _boundaries(groups, "label", "group_key", cuts, f"split-{seed}")


def bucket_split(key: Column, seed: int = SEED, train: float = 0.70, valid: float = 0.15) -> Column:
    """Split by hash bucket of the group key: no shuffle, stable when rows are added."""
    bucket = F.pmod(hash32(f"split-{seed}", key), F.lit(10_000))
    return (
        F.when(bucket < int(round(train * 10_000)), "train")
        .when(bucket < int(round((train + valid) * 10_000)), "valid")
        .otherwise("test")
    )


def split_by_group(
    df: DataFrame, seed: int = SEED, sizes: Mapping[str, int] = SPLIT_SIZES, exact: bool = True
) -> DataFrame:
    """Rows with a split by group; no group is in two splits.

    Mixed-label groups are an error. Exact mode gives the stratified sizes; otherwise the split
    is an expression of the key. Only the narrow group table is shuffled, and it is written once
    for the guard, the counts and the cuts. The rows stay where they are: a group has one label,
    so a row's own label and key place it.
    """
    if "group_key" not in df.columns:
        df = with_group_key(df)
    groups = written(group_labels(df), "groups")
    if not groups.filter("is_mixed").isEmpty():
        raise ValueError("Mixed-label groups detected; cannot keep a leakage-safe split.")
    if not exact:
        return df.withColumn("split", bucket_split(F.col("group_key"), seed))
    bounds = split_boundaries(groups, seed, sizes)
    return apply_boundaries(df, bounds, "label", "group_key", f"split-{seed}", "split", rest="test")


def assign_by_group(df: DataFrame, assigned: DataFrame) -> DataFrame:
    """Rows take the split of a caller's (group_key, split) map. A row without one stops the job."""
    joined = df.join(assigned, "group_key", "left")
    missing = F.raise_error(F.concat(F.lit("No split for group "), F.col("group_key"))).cast("string")
    return joined.withColumn("split", F.coalesce("split", missing)).select(*df.columns, "split")


def one_split(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def concat_splits(*splits: DataFrame) -> DataFrame:
    out = splits[0]
    for part in splits[1:]:
        out = out.unionByName(part)
    return out


# ---- leakage and counts ------------------------------------------------------------------


def leakage(df: DataFrame, key: Column | str = "group_key", left: str = "train", right: str = "test") -> DataFrame:
    """Distinct right keys, how many of them the left split has, and the rate.

    One pass: each key is marked by the splits it occurs in, which combines before the shuffle.
    """
    key = key if isinstance(key, Column) else F.col(key)
    seen = df.groupBy(key.alias("_key")).agg(
        F.bool_or(F.col("split") == left).alias("in_left"), F.bool_or(F.col("split") == right).alias("in_right")
    )
    counted = seen.agg(
        F.count_if("in_right").alias("right_keys"), F.count_if(F.col("in_left") & F.col("in_right")).alias("shared_keys")
    )
    rate = F.when(F.col("right_keys") == 0, F.lit(0.0)).otherwise(F.col("shared_keys") / F.col("right_keys"))
    return counted.withColumn("rate", rate)


def source_by_split(df: DataFrame) -> DataFrame:
    return df.groupBy("split", "source_dataset").agg(F.count("*").alias("count"))


def as_metrics(one_row: DataFrame) -> DataFrame:
    """One row of numbers as (metric, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one_row.columns])
    return one_row.select(F.explode(pairs).alias("m")).select("m.*")


def funnel(records: DataFrame, split: DataFrame) -> DataFrame:
    """Counts at every stage as (metric, value): two aggregates and the leakage rate.

    Distinct bodies are counted from the hash column alone, so no text is shuffled.
    """
    sound = ~F.col("is_corrupted")
    stages = records.agg(
        F.count("*").alias("parsed_total"),
        F.count_if(sound).alias("after_corrupt_filter"),
        F.count_distinct(F.when(sound, F.col("duplicate_group"))).alias("after_dedup"),
    )
    final = split.agg(
        F.count("*").alias("final_size"),
        F.count_if(F.col("label") == 0).alias("ham"),
        F.count_if(F.col("label") == 1).alias("spam"),
        *[F.count_if(F.col("split") == name).alias(name) for name in ("train", "valid", "test")],
    )
    leaked = leakage(split).select(F.col("rate").alias("train_test_leakage_rate"))
    return as_metrics(stages).unionByName(as_metrics(final)).unionByName(as_metrics(leaked))
