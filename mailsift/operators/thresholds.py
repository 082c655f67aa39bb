"""Threshold sweep in one pass, and the choice under a precision floor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.config import PRECISION_FLOOR, THRESHOLD_END, THRESHOLD_START, THRESHOLD_STEP
from mailsift.operators.metrics import prefix_counts, rates, report_from_prefix, score_histogram


def grid(start: float = THRESHOLD_START, end: float = THRESHOLD_END, step: float = THRESHOLD_STEP) -> list[float]:
    """Two-decimal thresholds from ``start`` to ``end``."""
    steps = int((end + 1e-9 - start) / step) + 1
    return [round(start + i * step, 2) for i in range(steps)]


def grid_index(score: Column, thresholds: list[float]) -> Column:
    """How many thresholds are <= score: a guess by division, then corrected by comparison."""
    if len(thresholds) == 1:
        return (score >= thresholds[0]).cast("int")
    values = F.array(*[F.lit(t) for t in thresholds])
    step = (thresholds[-1] - thresholds[0]) / (len(thresholds) - 1)
    guess = F.floor((score - thresholds[0]) / F.lit(step)).cast("int") + 1
    low = F.greatest(F.lit(0), F.least(F.lit(len(thresholds)), guess - 1))
    up = [
        F.coalesce((F.get(values, low + i) <= score), F.lit(False)).cast("int") for i in range(3)
    ]
    return low + up[0] + up[1] + up[2]


def sweep_from_prefix(prefix: DataFrame, keys: tuple[str, ...], thresholds: list[float]) -> DataFrame:
    """One row per key and threshold: four threshold metrics and four threshold-free ones.

    Each distinct score falls in one grid cell; suffix sums over the cells give the confusion
    counts of every threshold, so the scores are read once and not once per threshold.
    """
    whole = report_from_prefix(prefix, F.lit(0.5), keys).select(
        *keys, "pr_auc", "roc_auc", "brier", "ece", (F.col("tp") + F.col("fn")).alias("_all_pos"),
        (F.col("tn") + F.col("fp")).alias("_all_neg"),
    )
    cells = prefix.groupBy(*keys, grid_index(F.col("score"), thresholds).alias("_cell")).agg(
        F.sum("pos").alias("_pos"), F.sum("n").alias("_n")
    )
    grid_rows = F.posexplode(F.array(*[F.lit(t) for t in thresholds])).alias("_at", "threshold")
    frame = whole.select("*", grid_rows).withColumn("_cell", F.col("_at") + 1)
    at_or_above = Window.partitionBy(*keys, F.lit(0)).orderBy(F.col("_cell").desc()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    tp = F.coalesce(F.sum("_pos").over(at_or_above), F.lit(0))
    said = F.coalesce(F.sum("_n").over(at_or_above), F.lit(0))
    counted = frame.join(F.broadcast(cells), [*keys, "_cell"], "left").select(
        *frame.columns, tp.alias("tp"), (said - tp).alias("fp")
    )
    counted = counted.withColumns(
        {"fn": F.col("_all_pos") - F.col("tp"), "tn": F.col("_all_neg") - F.col("fp")}
    )
    return counted.withColumns(rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])).select(
        *keys, "threshold", "precision", "recall", "f1", "macro_f1", "pr_auc", "roc_auc", "brier", "ece"
    )


def threshold_sweep(
    scored: DataFrame,
    keys: tuple[str, ...] = (),
    thresholds: list[float] | None = None,
    prob: str = "probability",
    label: str = "label",
) -> DataFrame:
    prefix = prefix_counts(score_histogram(scored, keys, prob, label), keys)
    return sweep_from_prefix(prefix, keys, thresholds or grid())


def choose_threshold(sweep: DataFrame, keys: tuple[str, ...] = (), floor: float = PRECISION_FLOOR) -> DataFrame:
    """The best sweep row per key.

    Rows at or above the precision floor win, by F1, recall, nearness to 0.5, then the lower
    threshold; where none reaches it, by precision, F1, recall, then the lower threshold.
    """
    meets = F.col("precision") >= floor
    order = F.struct(
        (~meets).alias("a"),
        F.when(meets, -F.col("f1")).otherwise(-F.col("precision")).alias("b"),
        F.when(meets, -F.col("recall")).otherwise(-F.col("f1")).alias("c"),
        F.when(meets, F.abs(F.col("threshold") - 0.5)).otherwise(-F.col("recall")).alias("d"),
        F.col("threshold").alias("e"),
    )
    picked = [c for c in sweep.columns if c not in keys]
    best = sweep.groupBy(*keys).agg(F.min_by(F.struct(*picked), order).alias("_best"))
    return best.select(*keys, "_best.*")


def threshold_analysis(predictions: DataFrame, floor: float = PRECISION_FLOOR) -> DataFrame:
    """Chosen threshold per model, from the calibrated score where there is one.

    ``predictions`` has model, label, probability and optionally ``prob_after``.
    """
    score = (
        F.coalesce("prob_after", "probability") if "prob_after" in predictions.columns else F.col("probability")
    )
    scored = predictions.select("model", "label", score.alias("probability"))
    best = choose_threshold(threshold_sweep(scored, ("model",)), ("model",), floor)
    return best.select(
        "model",
        F.col("threshold").alias("selected_threshold"),
        F.col("precision").alias("best_precision"),
        F.col("recall").alias("best_recall"),
        F.col("f1").alias("best_f1"),
    )
