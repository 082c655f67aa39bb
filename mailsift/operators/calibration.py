"""Probability calibration: temperature by a one-pass grid, sigmoid by a one-feature fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailsift.functions.probability import apply_sigmoid, apply_temperature, logit, sigmoid
from mailsift.operators.linear import fit_line
from mailsift.operators.metrics import report, score_histogram

# 91 candidate temperatures from 0.5 in steps of 0.05.
TEMPERATURES = tuple(0.5 + i * 0.05 for i in range(91))


def temperature_losses(
    scored: DataFrame, keys: tuple[str, ...] = (), prob: str = "probability", label: str = "label"
) -> DataFrame:
    """(keys, temperature, loss): mean log-loss of every candidate, in one pass.

    Equal scores are counted first, so each distinct score meets the grid once; the 91 partial
    sums are combined before the shuffle.
    """
    hist = score_histogram(scored, keys, prob, label)
    cells = hist.select(
        *keys, "pos", "n", logit(F.col("score")).alias("_z"),
        F.explode(F.array(*[F.lit(t) for t in TEMPERATURES])).alias("temperature"),
    )
    p = sigmoid(F.col("_z") / F.col("temperature"))
    loss = -(F.col("pos") * F.log(p) + (F.col("n") - F.col("pos")) * F.log(F.lit(1.0) - p))
    return cells.groupBy(*keys, "temperature").agg((F.sum(loss) / F.sum("n")).alias("loss"))


def fit_temperature(
    scored: DataFrame, keys: tuple[str, ...] = (), prob: str = "probability", label: str = "label"
) -> DataFrame:
    """(keys, temperature, loss) of the smallest loss; the lowest temperature wins a tie."""
    losses = temperature_losses(scored, keys, prob, label)
    best = losses.groupBy(*keys).agg(
        F.min_by(F.struct("temperature", "loss"), F.struct("loss", "temperature")).alias("_best")
    )
    return best.select(*keys, "_best.*")


def scale_by_temperature(scored: DataFrame, fitted: DataFrame, keys: tuple[str, ...] = (), prob: str = "probability", out: str = "prob_after") -> DataFrame:
    """Calibrated scores from a fitted table: one row per key, or one row in all."""
    if keys:
        joined = scored.join(F.broadcast(fitted.select(*keys, "temperature")), list(keys))
        return joined.withColumn(out, apply_temperature(F.col(prob), F.col("temperature"))).drop("temperature")
    return scored.withColumn(out, apply_temperature(F.col(prob), fitted.select("temperature").scalar()))


def fit_sigmoid(scored: DataFrame, prob: str = "probability", label: str = "label") -> dict[str, float]:
    """Slope and intercept of a regularised logistic fit (C = 1) on the logit of the score."""
    return fit_line(scored, logit(F.col(prob)), F.col(label).cast("double"), F.lit(1.0), penalty=1.0)


def scale_by_sigmoid(scored: DataFrame, fitted: dict[str, float], prob: str = "probability", out: str = "prob_after") -> DataFrame:
    return scored.withColumn(out, apply_sigmoid(F.col(prob), fitted["slope"], fitted["intercept"]))


def calibrated_table(scored: DataFrame) -> DataFrame:
    """(email_id, y_true, prob_before, prob_after)."""
    return scored.select(
        "email_id", F.col("label").alias("y_true"), F.col("probability").alias("prob_before"), "prob_after"
    )


def before_after(scored: DataFrame, model: str, calibration_type: str) -> DataFrame:
    """One row: Brier, ECE and average precision before and after calibration.

    Both reports come from one histogram keyed by stage.
    """
    stages = F.array(
        F.struct(F.lit("before").alias("stage"), F.col("probability").alias("p")),
        F.struct(F.lit("after").alias("stage"), F.col("prob_after").alias("p")),
    )
    long = scored.select("label", F.explode(stages).alias("_s")).select(
        "label", F.col("_s.stage").alias("stage"), F.col("_s.p").alias("probability")
    )
    both = report(long, 0.5, ("stage",))
    picked = [
        F.max(F.when(F.col("stage") == stage, F.col(metric))).alias(f"{metric}_{stage}")
        for metric in ("brier", "ece", "pr_auc")
        for stage in ("before", "after")
    ]
    return both.agg(*picked).select(
        F.lit(model).alias("model"), F.lit(calibration_type).alias("calibration_type"), "*"
    )
