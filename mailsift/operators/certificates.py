"""Proofs that iterative fits are where they should be, as aggregates over all rows.

Each certificate is a table (check, value, ok). The rows are read in one pass per check and combine in
the map tasks; what reaches the driver is one number per check, what is grouped is one row per feature.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, functions as F

from mailsift.operators.linear import LogisticScorer
from mailsift.operators.vectors import apply_svd, vector_entries

GRADIENT = 1e-5  # largest slope of the mean loss at an optimum
RESIDUAL = 1e-6  # of singular vectors, relative to the first singular value squared
PROBES = 4  # random combinations of all singular vectors that a residual is taken of


def _verdict(checks: Iterable[tuple[str, DataFrame, float]]) -> DataFrame:
    """(check, value, ok) from one-number frames and the most that each may be."""
    value = F.col("value").cast("double")
    parts = [
        df.toDF("value").select(F.lit(name).alias("check"), value.alias("value"), (value <= most).alias("ok")) for name, df, most in checks
    ]
    return reduce(DataFrame.unionByName, parts)


def logistic_gradient(df: DataFrame, scorer: LogisticScorer, key: str = "email_id", weight: str | None = None, c: float = 1.0) -> DataFrame:
    """(idx, slope): the gradient of the penalised loss per unit of weight; index -1 is the intercept's."""
    w = F.col(weight) if weight else F.lit(1.0)
    scored = scorer.score(df).withColumn("_error", w * (F.col("probability") - F.col("label")))
    total = scored.agg(F.sum(w)).first()[0]
    coefficients = df.sparkSession.createDataFrame(list(enumerate(map(float, scorer.model.coefficients.toArray()))), "idx int, beta double")
    slopes = vector_entries(scored, "features", key, ("_error",)).groupBy("idx").agg(F.sum(F.col("_error") * F.col("weight")).alias("s"))
    features = coefficients.join(slopes, "idx", "left").select("idx", ((F.coalesce("s", F.lit(0.0)) + F.col("beta") / c) / total).alias("slope"))
    return features.union(scored.agg((F.sum("_error") / total).alias("slope")).select(F.lit(-1), "slope"))


def logistic_certificate(df: DataFrame, scorer: LogisticScorer, key: str = "email_id", weight: str | None = None) -> DataFrame:
    """The loss is convex, so a vanishing gradient proves the optimum, and its loss is below that of no model."""
    gradient = logistic_gradient(df, scorer, key, weight)
    w = F.col(weight) if weight else F.lit(1.0)
    p, y = F.col("probability"), F.col("label")
    penalty = float(np.sum(scorer.model.coefficients.toArray() ** 2) / 2)
    loss = F.sum(-w * F.log(F.when(y == 1, p).otherwise(1 - p))) + penalty
    share = F.sum(w * y) / F.sum(w)
    none = -F.sum(w) * (share * F.log(share) + (1 - share) * F.log(1 - share))
    scored = scorer.score(df)
    return _verdict([
        ("steepest slope of a feature", gradient.where("idx >= 0").agg(F.max(F.abs("slope"))), GRADIENT),
        ("slope of the intercept", gradient.where("idx < 0").agg(F.max(F.abs("slope"))), GRADIENT),
        ("loss against that of the mean", scored.agg(loss / none), 1.0),
    ])


def svd_certificate(df: DataFrame, values: np.ndarray, right: np.ndarray, vector_col: str = "features", key: str = "email_id", seed: int = 5) -> DataFrame:
    """Singular vectors are orthonormal, span an invariant space of the rows' Gram matrix, and explain no more than there is.

    The residual of ``A'A V - V S^2`` is taken on a few random combinations of the vectors, so a task
    holds features x probes numbers, and the sum over all rows is one aggregate by feature.
    """
    spark = df.sparkSession
    k = right.shape[1]
    mix = np.random.default_rng(seed).normal(size=(k, PROBES)) / np.sqrt(k)
    projected = apply_svd(df, right @ mix, vector_col, out="_p").select(key, vector_col, F.unwrap_udt("_p").getField("values").alias("_p"))
    entries = vector_entries(projected, vector_col, key, ("_p",))
    sums = entries.groupBy("idx").agg(*[F.sum(F.col("weight") * F.col("_p")[j]).alias(f"s{j}") for j in range(PROBES)])
    target = right @ (values[:, None] ** 2 * mix)
    wanted = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(target)], "idx int, " + ", ".join(f"t{j} double" for j in range(PROBES)))
    gap = [F.sum(F.pow(F.coalesce(f"s{j}", F.lit(0.0)) - F.coalesce(f"t{j}", F.lit(0.0)), F.lit(2.0))) for j in range(PROBES)]
    residual = sums.join(wanted, "idx", "full").agg((F.sqrt(F.greatest(*gap)) / float(values[0] ** 2)).alias("r"))
    energy = vector_entries(df, vector_col, key).agg((F.lit(float(np.sum(values**2))) / F.sum(F.col("weight") * F.col("weight"))).alias("e"))
    tilt = float(np.abs(right.T @ right - np.eye(k)).max())
    return _verdict([
        ("tilt of the vectors", spark.range(1).select(F.lit(tilt)), 1e-9),
        ("residual of the Gram matrix", residual, RESIDUAL),
        ("share of the squared length", energy, 1.0 + 1e-9),
    ])


