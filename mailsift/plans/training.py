"""Train, compare, calibrate and choose: the model side of the work, stage by stage."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from mailsift.config import PRECISION_FLOOR
from mailsift.operators import calibration as cal, linear, metrics as M, scoring as S, thresholds as T, vectors as V
from mailsift.session import side_by_side, written

NAMES = {"bayes": "multinomial_nb", "logistic": "logistic_regression", "svm": "linear_svm"}


@dataclass
class TrainedModels:
    """Bundles by name, their validation predictions in one table, and one metric row each."""

    bundles: dict[str, S.MailModel]
    predictions: DataFrame
    summary: DataFrame


def _vectors(train: DataFrame, valid: DataFrame):
    """One vectoriser for all models, and both splits as vectors, written once."""
    features = V.vectoriser(V.fit_vocabulary(train))
    keep = [c for c in train.columns if c != "clean_text"]
    return features, *(written(features.transform(df).select(*keep, "features"), "vectors") for df in (train, valid))


def _fitted(fits: dict[Hashable, Callable[[], S.Scorer]]) -> dict[Hashable, S.Scorer]:
    """All fits side by side: each is many short passes, which fill each other's gaps."""
    return dict(zip(fits, side_by_side(lambda fit: fit(), fits.values())))


def train_models(train: DataFrame, valid: DataFrame) -> TrainedModels:
    """Naive Bayes, balanced logistic regression and balanced calibrated SVM.

    ``train`` and ``valid`` have email_id, label, source_dataset and clean_text.
    """
    features, train_vectors, valid_vectors = _vectors(train, valid)
    weighted = linear.with_class_weight(train_vectors)
    scorers = _fitted({
        "bayes": lambda: linear.BayesScorer.fit(train_vectors),
        "logistic": lambda: linear.LogisticScorer(linear.fit_logistic(weighted, weight="weight")),
        "svm": lambda: linear.SvmScorer.fit(weighted, weight="weight"),
    })
    scored = [
        S.predictions(s.score(valid_vectors)).withColumn("model", F.lit(NAMES[kind])) for kind, s in scorers.items()
    ]
    predictions = written(reduce(DataFrame.unionByName, scored), "predictions")
    bundles = {NAMES[kind]: S.MailModel(features, s) for kind, s in scorers.items()}
    return TrainedModels(bundles, predictions, M.report(predictions, 0.5, ("model",)))


def compare_imbalance(train: DataFrame, valid: DataFrame, floor: float = PRECISION_FLOOR) -> DataFrame:
    """Eight rows: no weights, class weights, adjusted threshold and cost-sensitive, two models.

    Each model is fitted twice, with and without weights. The cost-sensitive strategy is the
    class-weight one by definition; the adjusted threshold is chosen under the precision floor.
    """
    _, train_vectors, valid_vectors = _vectors(train, valid)
    weighted = linear.with_class_weight(train_vectors)
    fits = _fitted({
        ("logistic", False): lambda: linear.LogisticScorer(linear.fit_logistic(train_vectors)),
        ("logistic", True): lambda: linear.LogisticScorer(linear.fit_logistic(weighted, weight="weight")),
        ("svm", False): lambda: linear.SvmScorer.fit(train_vectors),
        ("svm", True): lambda: linear.SvmScorer.fit(weighted, weight="weight"),
    })
    scored = [
        s.score(valid_vectors).select("label", "probability", F.lit(NAMES[kind]).alias("model"), F.lit(balanced).alias("balanced"))
        for (kind, balanced), s in fits.items()
    ]
    keys = ("model", "balanced")
    prefix = written(M.prefix_counts(M.score_histogram(reduce(DataFrame.unionByName, scored), keys), keys), "prefix")
    at_half = M.report_from_prefix(prefix, F.lit(0.5), keys).withColumn("threshold", F.lit(0.5))
    chosen = T.choose_threshold(T.sweep_from_prefix(prefix, keys, T.grid()), keys, floor)
    columns = ["threshold", "precision", "recall", "f1", "macro_f1", "pr_auc", "roc_auc", "brier", "ece"]

    def strategy(name: str, rows: DataFrame, balanced: bool) -> DataFrame:
        return rows.filter(F.col("balanced") == balanced).select(F.lit(name).alias("strategy"), "model", *columns)

    parts = [
        strategy("none", at_half, False), strategy("class_weight", at_half, True),
        strategy("threshold_adjust", chosen, True), strategy("cost_sensitive", at_half, True),
    ]
    return reduce(DataFrame.unionByName, parts)


@dataclass
class Calibrated:
    """Calibrated bundles, scores before and after, the comparison and the chosen thresholds."""

    bundles: dict[str, S.MailModel]
    scores: DataFrame
    comparison: DataFrame
    thresholds: DataFrame


def calibrate_models(trained: TrainedModels, fit_on: DataFrame | None = None) -> Calibrated:
    """Temperature for logistic regression, sigmoid for the SVM, then a threshold for each.

    By default calibrators are fitted on the rows they are judged on, as published; pass
    ``fit_on`` (model, label, probability) to hold the fit out.
    """
    def calibrated(of: tuple[str, str]) -> tuple[S.MailModel, DataFrame, DataFrame]:
        name, kind = of
        scored = trained.predictions.filter(F.col("model") == name)
        source = scored if fit_on is None else fit_on.filter(F.col("model") == name)
        if kind == "temperature":
            fitted = {"temperature": float(cal.fit_temperature(source).first()["temperature"])}
            after = scored.withColumn("prob_after", cal.apply_temperature(F.col("probability"), fitted["temperature"]))
        else:
            fitted = cal.fit_sigmoid(source)
            after = cal.scale_by_sigmoid(scored, fitted)
        bundle = trained.bundles[name]
        return S.MailModel(bundle.features, bundle.scorer, fitted, bundle.text_col), after, cal.before_after(after, name, kind)

    kinds = {NAMES["logistic"]: "temperature", NAMES["svm"]: "sigmoid"}
    bundles, tables, rows = zip(*side_by_side(calibrated, kinds.items()))
    scores = written(reduce(DataFrame.unionByName, tables), "calibrated")
    return Calibrated(dict(zip(kinds, bundles)), scores, reduce(DataFrame.unionByName, rows), T.threshold_analysis(scores))
