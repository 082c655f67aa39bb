"""Linear models with the published objective: naive Bayes by ``pyspark.ml``, the others by ``descent`` and ``planes``."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailsift.config import NB_ALPHA, SEED
from mailsift.functions.probability import sigmoid
from mailsift.operators.curate import class_counts, stratified_folds
from mailsift.operators.descent import Rows, Unfinished, descend, logistic
from mailsift.operators.planes import hinge_fits
from mailsift.operators.vectors import projected
from mailsift.session import written

FOLDS = 3
LOGISTIC_ITERATIONS, LOGISTIC_TOLERANCE = 2000, 1e-10
SVM_ITERATIONS, SVM_TOLERANCE = 5000, 1e-6
GAP = 1e-3  # largest share of the penalised hinge loss that may lie above its lower bound


@dataclass
class LinearModel:
    """Coefficients and intercept of a margin."""

    coefficients: DenseVector
    intercept: float

    @staticmethod
    def of(at: np.ndarray) -> "LinearModel":
        return LinearModel(DenseVector(at[:-1]), float(at[-1]))

    def save(self, path: str) -> None:
        row = ([float(w) for w in self.coefficients.toArray()], self.intercept)
        SparkSession.active().createDataFrame([row], "coefficients array<double>, intercept double").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(path: str) -> "LinearModel":
        row = SparkSession.active().read.parquet(path).first()
        return LinearModel(DenseVector(row["coefficients"]), float(row["intercept"]))


def with_margins(df: DataFrame, models: list[LinearModel], out: str) -> DataFrame:
    """Rows with the array of their margins by each of the models, in one pass over their features."""
    right = np.stack([m.coefficients.toArray() for m in models], 1)
    raw = projected(df, right, "features", out)
    return raw.withColumn(out, F.array(*[F.col(out)[i] + F.lit(m.intercept) for i, m in enumerate(models)]))


def class_weights(df: DataFrame) -> DataFrame:
    """(label, n, weight) with weight n / (classes * n of the class)."""
    counts = df.groupBy("label").agg(F.count("*").alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    return counts.withColumn("weight", whole["rows"] / (whole["classes"] * F.col("n")))


def with_class_weight(df: DataFrame, out: str = "weight") -> DataFrame:
    """Rows with their balanced class weight, as an expression of the label."""
    counts = class_counts(df)
    weight = F.lit(None).cast("double")
    for label, n in counts.items():
        weight = F.when(F.col("label") == label, F.lit(sum(counts.values()) / (len(counts) * n))).otherwise(weight)
    return df.withColumn(out, weight)


def fit_logistic(
    df: DataFrame, weight: str | None = None, c: float = 1.0, features: str = "features",
    max_iter: int = LOGISTIC_ITERATIONS, tol: float = LOGISTIC_TOLERANCE,
) -> LinearModel:
    """L2 logistic regression with inverse strength ``c``; the intercept is not penalised.

    A fit that reaches ``max_iter`` before the relative tolerance ``tol`` is an error.
    """
    with Rows(df, weight, features) as rows:
        try:
            found, _ = descend(rows, np.zeros(rows.size + 1), logistic, 1.0 / c if c else 0.0, tol, max_iter)
        except Unfinished as error:
            raise RuntimeError(f"Logistic regression {error}: raise max_iter or tol.") from error
    return LinearModel.of(found.at)


def fit_svms(
    df: DataFrame, weight: str | None = None, fold: str = "_fold", c: float = 1.0, max_iter: int = SVM_ITERATIONS, tol: float = SVM_TOLERANCE
) -> list[LinearModel]:
    """The support vector machine of the hinge loss without each of the folds, within ``GAP`` of its lowest value (four times ``tol`` if that is more).

    All are fitted in the same passes over the rows.
    """
    with Rows(df, weight, fold=fold) as rows:
        try:
            return [LinearModel.of(at) for at in hinge_fits(rows, list(range(FOLDS)), 1.0 / c, max(GAP, 4 * tol), max_iter)]
        except Unfinished as error:
            raise RuntimeError(f"The support vector machine {error}: raise max_iter or tol.") from error


def fit_platt(df: DataFrame, margin: str = "margin", weight: str | None = None) -> dict[str, float]:
    """Sigmoid on margins with Platt's smoothed targets, unpenalised.

    A soft target t is a pair of rows, label 1 with weight t and label 0 with weight 1 - t.
    """
    counts = class_counts(df)
    high = (counts.get(1, 0) + 1.0) / (counts.get(1, 0) + 2.0)
    low = 1.0 / (counts.get(0, 0) + 2.0)
    target = F.when(F.col("label") == 1, F.lit(high)).otherwise(F.lit(low))
    return fit_line(df, F.col(margin), target, F.col(weight) if weight else F.lit(1.0), penalty=0.0)


def fit_line(df: DataFrame, x: Column, target: Column, weight: Column, penalty: float, most: int = 50) -> dict[str, float]:
    """Slope and intercept of a logistic curve through soft targets, to rounding error.

    A soft target t is a pair of rows, label 1 with weight t and label 0 with weight 1 - t, so all that
    counts is the weight and the target weight at each distinct ``x``. These are added up and written
    once; Newton steps are aggregates over that table, halved while they raise the loss.
    """
    table = written(
        df.select(x.cast("double").alias("x"), (weight * target).alias("t"), weight.alias("w"))
        .groupBy("x").agg(F.sum("t").alias("t"), F.sum("w").alias("w")), "line",
    )

    # In units of its deviation any ``x`` is as easy as another; the penalty follows.
    middle, scale = table.agg(F.avg("x"), F.stddev_pop("x")).first()
    scale = scale or 1.0
    u, penalty = (F.col("x") - middle) / scale, penalty / scale**2

    def state(a: float, b: float):
        z = F.lit(a) * u + F.lit(b)
        p, w = sigmoid(z), F.col("w")
        error, curve = w * p - F.col("t"), w * p * (1.0 - p)
        positive = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))  # log(1 + exp(z)) for any z
        return table.agg(
            F.sum(w * positive - F.col("t") * z).alias("loss"), F.sum(error * u).alias("ga"), F.sum(error).alias("gb"),
            F.sum(curve * u * u).alias("aa"), F.sum(curve * u).alias("ab"), F.sum(curve).alias("bb"), F.sum("w").alias("w"),
        ).first()

    a = b = 0.0
    now = state(a, b)
    for _ in range(most):
        ga, aa = now.ga + penalty * a, now.aa + penalty
        if max(abs(ga), abs(now.gb)) <= 1e-11 * now.w:
            return {"slope": a / scale, "intercept": b - a * middle / scale}
        whole, step = aa * now.bb - now.ab**2, 1.0
        if whole > 1e-12 * aa * now.bb:
            da, db = (now.bb * ga - now.ab * now.gb) / whole, (aa * now.gb - now.ab * ga) / whole
        else:  # one value of x: any slope is as good
            da, db = 0.0, now.gb / now.bb
        while True:
            after = state(a - step * da, b - step * db)
            if after.loss + penalty * (a - step * da) ** 2 / 2 <= now.loss + penalty * a**2 / 2 + 1e-12 * now.w or step < 1e-6:
                break
            step /= 2
        a, b, now = a - step * da, b - step * db, after
    raise RuntimeError(f"The sigmoid has no optimum within {most} steps: are the classes apart?")


@dataclass
class LogisticScorer:
    """Logistic regression with one probability column."""

    model: LinearModel

    def score(self, df: DataFrame, out: str = "probability") -> DataFrame:
        return with_margins(df, [self.model], "_margins").withColumn(out, sigmoid(F.col("_margins")[0])).drop("_margins")

    def save(self, path: str) -> dict:
        self.model.save(path + "/logistic")
        return {"kind": "logistic"}

    @staticmethod
    def load(path: str, facts: dict) -> "LogisticScorer":
        return LogisticScorer(LinearModel.load(path + "/logistic"))


@dataclass
class BayesScorer:
    """Spark's naive Bayes with its smoothed prior replaced by the class shares."""

    model: NaiveBayesModel
    prior_shift: float

    @staticmethod
    def fit(df: DataFrame, alpha: float = NB_ALPHA) -> "BayesScorer":
        import math

        counts = class_counts(df)
        model = NaiveBayes(smoothing=alpha, modelType="multinomial", featuresCol="features", labelCol="label").fit(df)
        smoothed = model.pi.toArray()
        return BayesScorer(model, math.log(counts[1] / counts[0]) - float(smoothed[1] - smoothed[0]))

    def score(self, df: DataFrame, out: str = "probability") -> DataFrame:
        model = self.model.copy()
        model.setRawPredictionCol("_raw").setProbabilityCol("_prob").setPredictionCol("_pred")
        raw = vector_to_array("_raw")
        scored = model.transform(df).withColumn("_r", raw)
        log_odds = F.col("_r")[1] - F.col("_r")[0] + F.lit(self.prior_shift)
        return scored.withColumn(out, sigmoid(log_odds)).drop("_raw", "_prob", "_pred", "_r")

    def save(self, path: str) -> dict:
        self.model.write().overwrite().save(path + "/bayes")
        return {"kind": "bayes", "prior_shift": self.prior_shift}

    @staticmethod
    def load(path: str, facts: dict) -> "BayesScorer":
        return BayesScorer(NaiveBayesModel.load(path + "/bayes"), float(facts["prior_shift"]))


@dataclass
class SvmScorer:
    """Linear support vector machines of three stratified folds, each with its own sigmoid; scores averaged.

    The loss is the hinge, not its square, so scores are close to the published ones and
    not equal. A fit that reaches ``max_iter`` is an error.
    """

    models: list[LinearModel]
    sigmoids: list[dict[str, float]]

    @staticmethod
    def fit(
        df: DataFrame, weight: str | None = None, key: str = "email_id", seed: int = SEED, c: float = 1.0,
        max_iter: int = SVM_ITERATIONS, tol: float = SVM_TOLERANCE,
    ) -> "SvmScorer":
        folded = written(stratified_folds(df, FOLDS, seed, key), "folds")

        models = fit_svms(folded, weight, "_fold", c, max_iter, tol)

        def fit_sigmoid(fold: int) -> dict[str, float]:
            held_out = with_margins(folded.filter(F.col("_fold") == fold), [models[fold]], "margin").withColumn("margin", F.col("margin")[0])
            return fit_platt(held_out, "margin", weight)

        with ThreadPoolExecutor(FOLDS) as pool:  # a pass is short: those of the folds fill each other's gaps
            sigmoids = list(pool.map(fit_sigmoid, range(FOLDS)))
        return SvmScorer(models, sigmoids)

    def score(self, df: DataFrame, out: str = "probability") -> DataFrame:
        df, total = with_margins(df, self.models, "_margins"), F.lit(0.0)
        for i, fitted in enumerate(self.sigmoids):
            total = total + sigmoid(F.lit(fitted["slope"]) * F.col("_margins")[i] + F.lit(fitted["intercept"]))
        return df.withColumn(out, total / F.lit(float(len(self.models)))).drop("_margins")

    def save(self, path: str) -> dict:
        for i, model in enumerate(self.models):
            model.save(f"{path}/svm-{i}")
        return {"kind": "svm", "sigmoids": [[s["slope"], s["intercept"]] for s in self.sigmoids]}

    @staticmethod
    def load(path: str, facts: dict) -> "SvmScorer":
        fitted = [{"slope": s, "intercept": i} for s, i in facts["sigmoids"]]
        return SvmScorer([LinearModel.load(f"{path}/svm-{i}") for i in range(len(fitted))], fitted)


SCORERS = {"logistic": LogisticScorer, "bayes": BayesScorer, "svm": SvmScorer}


def coefficient_table(spark: SparkSession, vocabulary: list[str], scorer: LogisticScorer) -> DataFrame:
    """(feature, weight): one row per vocabulary term."""
    weights = [float(w) for w in scorer.model.coefficients.toArray()]
    return spark.createDataFrame(list(zip(vocabulary, weights)), "feature string, weight double")
