"""Binary-classifier metrics from a histogram of scores.

Every metric is a function of (score, positives, rows). The histogram combines before its one
shuffle; metrics that need an order are prefix sums over range partitions of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.session import bounded_side, written

ECE_BINS = 10


def score_histogram(scored: DataFrame, keys: tuple[str, ...] = (), prob: str = "probability", label: str = "label") -> DataFrame:
    """(keys, score, pos, n): positives and rows per distinct score."""
    return scored.groupBy(*keys, F.col(prob).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count("*").alias("n")
    )


def prefix_counts(hist: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Add ``cum_pos`` and ``cum_n``, counts at this score or above, and ``all_pos`` and ``all_n``, per key.

    The histogram is range-partitioned by score and written once with its partition numbers.
    Each partition sums its own rows; the offsets before it and the totals of a key come from one
    total per key and partition, a few more rows than there are partitions. No window and no join
    spans a whole key.
    """
    placed = written(hist.repartitionByRange(*keys, F.col("score").desc()).withColumn("_part", F.spark_partition_id()), "histogram")
    totals = placed.groupBy(*keys, "_part").agg(F.sum("pos").alias("_pos"), F.sum("n").alias("_n"))
    whole = Window.partitionBy(*keys, F.lit(0))
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_part",
        F.coalesce(F.sum("_pos").over(earlier), F.lit(0)).alias("_pos_before"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
        F.sum("_pos").over(whole).alias("all_pos"),
        F.sum("_n").over(whole).alias("all_n"),
    )
    within = Window.partitionBy(*keys, "_part").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(bounded_side(written(offsets, "offsets")), [*keys, "_part"])
        .withColumn("cum_pos", F.col("_pos_before") + F.sum("pos").over(within))
        .withColumn("cum_n", F.col("_n_before") + F.sum("n").over(within))
        .select(*keys, "score", "pos", "n", "cum_pos", "cum_n", "all_pos", "all_n")
    )


def _f1(tp: Column, wrong: Column) -> Column:
    """2 tp / (2 tp + false positives + false negatives), 0 when the class is absent."""
    whole = 2 * tp + wrong
    return F.when(whole == 0, F.lit(0.0)).otherwise(2 * tp / whole)


def rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Precision, recall, F1 and macro F1; a zero denominator gives 0.

    Macro F1 averages over the classes that occur in truth or prediction.
    """
    wrong = fp + fn
    has_pos, has_neg = (tp + wrong) > 0, (tn + wrong) > 0
    present = has_pos.cast("int") + has_neg.cast("int")
    both = F.when(has_pos, _f1(tp, wrong)).otherwise(0.0) + F.when(has_neg, _f1(tn, wrong)).otherwise(0.0)
    return {
        "precision": F.when(tp + fp == 0, F.lit(0.0)).otherwise(tp / (tp + fp)),
        "recall": F.when(tp + fn == 0, F.lit(0.0)).otherwise(tp / (tp + fn)),
        "f1": _f1(tp, wrong),
        "macro_f1": F.when(present == 0, F.lit(0.0)).otherwise(both / present),
    }


def confusion(
    scored: DataFrame, threshold: float | Column, keys: tuple[str, ...] = (), prob: str = "probability", label: str = "label"
) -> DataFrame:
    """tn, fp, fn, tp at ``p >= threshold``."""
    said = F.col(prob) >= threshold
    true = F.col(label) == 1
    return scored.groupBy(*keys).agg(
        F.count_if(~true & ~said).alias("tn"),
        F.count_if(~true & said).alias("fp"),
        F.count_if(true & ~said).alias("fn"),
        F.count_if(true & said).alias("tp"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")]))


def brier(scored: DataFrame, keys: tuple[str, ...] = (), prob: str = "probability", label: str = "label") -> DataFrame:
    return scored.groupBy(*keys).agg(F.avg(F.pow(F.col(prob) - F.col(label), F.lit(2.0))).alias("brier"))


def left_closed_bin(score: Column, bins: int = ECE_BINS) -> Column:
    """Bin i holds edge i <= p < edge i+1; p = 1 is in no bin. Edges are i * (1/bins)."""
    index = F.lit(0)
    for i in range(1, bins):
        index = index + (score >= F.lit(i * (1.0 / bins))).cast("int")
    return F.when((score >= 0.0) & (score < 1.0), index)


def right_closed_bin(score: Column, bins: int = ECE_BINS) -> Column:
    """Bin i holds edge i < p <= edge i+1, as a left-sided search of the inner edges gives."""
    index = F.lit(0)
    for i in range(1, bins):
        index = index + (score > F.lit(i * (1.0 / bins))).cast("int")
    return index


def ece(hist: DataFrame, keys: tuple[str, ...] = (), bins: int = ECE_BINS) -> DataFrame:
    """Expected calibration error over left-closed bins, from a score histogram."""
    weight = F.col("n")
    per_bin = hist.groupBy(*keys, left_closed_bin(F.col("score"), bins).alias("_bin")).agg(
        F.sum("pos").alias("_pos"), F.sum(weight).alias("_n"), F.sum(F.col("score") * weight).alias("_p")
    )
    gap = F.abs(F.col("_pos") / F.col("_n") - F.col("_p") / F.col("_n")) * F.col("_n")
    return per_bin.groupBy(*keys).agg(
        (F.coalesce(F.sum(F.when(F.col("_bin").isNotNull(), gap)), F.lit(0.0)) / F.sum("_n")).alias("ece")
    )


def reliability_curve(hist: DataFrame, keys: tuple[str, ...] = (), bins: int = ECE_BINS) -> DataFrame:
    """Mean score and share of positives per non-empty right-closed bin."""
    return hist.groupBy(*keys, right_closed_bin(F.col("score"), bins).alias("bin")).agg(
        (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("prob_pred"),
        (F.sum("pos") / F.sum("n")).alias("prob_true"),
        F.sum("n").alias("n"),
    )


def _area_columns() -> tuple[Column, Column]:
    """Average precision and ROC area as single aggregates over prefix counts.

    Ties count one half. Average precision is 0 without positives; the ROC area is null when
    either class is absent.
    """
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    all_pos = F.sum("pos")
    all_neg = F.sum(neg)
    average_precision = F.sum(pos * (F.col("cum_pos") / F.col("cum_n"))) / all_pos
    neg_at_or_above = (F.col("cum_n") - F.col("cum_pos")).cast("double")
    lost = F.sum(pos * (neg_at_or_above - neg / 2.0))
    roc = F.lit(1.0) - lost / (all_pos.cast("double") * all_neg)
    return (
        F.when(all_pos == 0, F.lit(0.0)).otherwise(average_precision),
        F.when((all_pos > 0) & (all_neg > 0), roc),
    )


def ranking_areas(prefix: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """pr_auc and roc_auc from prefix counts, in one aggregate."""
    average_precision, roc = _area_columns()
    return prefix.groupBy(*keys).agg(average_precision.alias("pr_auc"), roc.alias("roc_auc"))


def _curve(prefix: DataFrame, keys: tuple[str, ...], point: dict[str, Column], end: dict[str, float]) -> DataFrame:
    """A point at every distinct score, and the ``end`` point beside the first score of each key."""
    none = F.lit(None).cast("double")
    own = F.struct(*[c.alias(n) for n, c in point.items()], F.col("score").alias("threshold"))
    extra = F.struct(*[F.lit(v).alias(n) for n, v in end.items()], none.alias("threshold"))
    points = F.when(F.col("cum_n") == F.col("n"), F.array(own, extra)).otherwise(F.array(own))
    return prefix.select(*keys, F.explode(points).alias("_point")).select(*keys, "_point.*")


def roc_points(prefix: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, plus the origin with a null threshold."""
    negatives = F.col("all_n") - F.col("all_pos")
    point = {"fpr": (F.col("cum_n") - F.col("cum_pos")) / F.nullif(negatives, F.lit(0)), "tpr": F.col("cum_pos") / F.nullif(F.col("all_pos"), F.lit(0))}
    return _curve(prefix, keys, point, {"fpr": 0.0, "tpr": 0.0})


def pr_points(prefix: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(recall, precision, threshold) at every distinct score, plus the end point (0, 1)."""
    point = {"recall": F.col("cum_pos") / F.nullif(F.col("all_pos"), F.lit(0)), "precision": F.col("cum_pos") / F.col("cum_n")}
    return _curve(prefix, keys, point, {"recall": 0.0, "precision": 1.0})


def report(
    scored: DataFrame,
    threshold: float = 0.5,
    keys: tuple[str, ...] = (),
    prob: str = "probability",
    label: str = "label",
) -> DataFrame:
    """One row per key: the eight metrics and the confusion counts at ``threshold``."""
    prefix = prefix_counts(score_histogram(scored, keys, prob, label), keys)
    return report_from_prefix(prefix, F.lit(float(threshold)), keys)


def report_from_prefix(prefix: DataFrame, threshold: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """The report from prefix counts. Two small aggregates of the written histogram are joined."""
    score, pos, n = F.col("score"), F.col("pos"), F.col("n")
    said = score >= threshold
    zero = F.lit(0)
    average_precision, roc = _area_columns()
    squared = pos * F.pow(score - 1.0, F.lit(2.0)) + (n - pos) * F.pow(score, F.lit(2.0))
    per_bin = prefix.groupBy(*keys, left_closed_bin(score).alias("_bin")).agg(
        F.sum("pos").alias("_bin_pos"),
        F.sum("n").alias("_bin_n"),
        F.sum(score * n).alias("_bin_p"),
    )
    gap = F.abs(F.col("_bin_pos") / F.col("_bin_n") - F.col("_bin_p") / F.col("_bin_n")) * F.col("_bin_n")
    whole = [*keys, F.lit(0).alias("_all")]
    error = per_bin.groupBy(*whole).agg(
        (F.coalesce(F.sum(F.when(F.col("_bin").isNotNull(), gap)), F.lit(0.0)) / F.sum("_bin_n")).alias("ece")
    )
    counts = prefix.groupBy(*whole).agg(
        F.sum(F.when(~said, n - pos).otherwise(zero)).alias("tn"),
        F.sum(F.when(said, n - pos).otherwise(zero)).alias("fp"),
        F.sum(F.when(~said, pos).otherwise(zero)).alias("fn"),
        F.sum(F.when(said, pos).otherwise(zero)).alias("tp"),
        average_precision.alias("pr_auc"),
        roc.alias("roc_auc"),
        (F.sum(squared) / F.sum("n")).alias("brier"),
    )
    return with_rates(counts.join(error, [*keys, "_all"])).select(
        *keys, "precision", "recall", "f1", "macro_f1", "pr_auc", "roc_auc", "brier", "ece", "tn", "fp", "fn", "tp"
    )
