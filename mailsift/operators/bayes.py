"""Multinomial naive Bayes on TF-IDF weights as aggregates and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailsift.config import NB_ALPHA
from mailsift.functions.probability import sigmoid
from mailsift.session import written


def fit_naive_bayes(weights: DataFrame, documents: DataFrame, alpha: float = NB_ALPHA) -> DataFrame:
    """(term, log_ratio, log_prior): the two-class model as one log ratio per term.

    ``weights`` is the long TF-IDF table of the training documents with ``label``; priors are
    the unsmoothed class shares of ``documents``. The sums have one row per vocabulary term and
    are written once.
    """
    is_spam = F.col("label") == 1
    per_term = written(
        weights.groupBy("term").agg(
            F.sum(F.when(~is_spam, F.col("weight")).otherwise(0.0)).alias("_w0"),
            F.sum(F.when(is_spam, F.col("weight")).otherwise(0.0)).alias("_w1"),
        ), "term-sums",
    )
    totals = per_term.agg(
        F.struct(F.sum("_w0").alias("w0"), F.sum("_w1").alias("w1"), F.count("*").alias("terms"))
    ).scalar()
    classes = documents.agg(
        F.struct(F.count_if(~is_spam).alias("n0"), F.count_if(is_spam).alias("n1"))
    ).scalar()

    def log_theta(column: str, total: str):
        return F.log((F.col(column) + alpha) / (totals[total] + F.lit(alpha) * totals["terms"]))

    return per_term.select(
        "term",
        (log_theta("_w1", "w1") - log_theta("_w0", "w0")).alias("log_ratio"),
        F.log(classes["n1"] / classes["n0"]).alias("log_prior"),
    )


def score_naive_bayes(
    weights: DataFrame, model: DataFrame, documents: DataFrame, key: str = "email_id"
) -> DataFrame:
    """``documents`` with ``probability``; a document without known terms gets the prior.

    The model has one row per vocabulary term, a number bounded by ``max_features``.
    """
    prior = model.agg(F.max("log_prior")).scalar()
    evidence = (
        weights.select(key, "term", "weight")
        .join(F.broadcast(model.select("term", "log_ratio")), "term")
        .groupBy(key)
        .agg(F.sum(F.col("weight") * F.col("log_ratio")).alias("_evidence"))
    )
    joined = documents.join(evidence, key, "left")
    log_odds = prior + F.coalesce(F.col("_evidence"), F.lit(0.0))
    return joined.withColumn("probability", sigmoid(log_odds)).drop("_evidence")
