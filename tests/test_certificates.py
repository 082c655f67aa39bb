"""Certificates accept what is optimal and refuse what is not."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from mailsift.functions.probability import logit
from mailsift.operators import calibration as cal, certificates, linear, vectors as V
from pyspark.sql import functions as F


def _rows(spark, n=200, d=5):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.7)
    y = (x @ rng.normal(size=d) + rng.normal(size=n) > 0.5).astype(int)
    sparse = [Vectors.sparse(d, {j: float(v) for j, v in enumerate(row) if v}) for row in x]
    return x, y, spark.createDataFrame([(str(i), int(y[i]), sparse[i]) for i in range(n)], ["email_id", "label", "features"])


def test_a_finished_fit_passes_and_an_unfinished_one_does_not(spark):
    frame = linear.with_class_weight(_rows(spark)[2])
    good = linear.LogisticScorer(linear.fit_logistic(frame, weight="weight"))
    assert all(r.ok for r in certificates.logistic_certificate(frame, good, weight="weight").collect())
    plain = linear.LogisticScorer(linear.fit_logistic(frame))
    assert not all(r.ok for r in certificates.logistic_certificate(frame, plain, weight="weight").collect())


def test_svd_certificate(spark):
    frame = _rows(spark)[2]
    values, right = V.fit_svd(frame, k=3)
    assert all(r.ok for r in certificates.svd_certificate(frame, values, right).collect())
    turned = np.linalg.qr(right + 0.01)[0]
    found = {r.check: r.ok for r in certificates.svd_certificate(frame, values, turned).collect()}
    assert found["tilt of the vectors"] and not found["residual of the Gram matrix"]


def _newton(x, t, w, penalty):
    a = b = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([(w * (p - t) * x).sum() + penalty * a, (w * (p - t)).sum()])
        s = w * p * (1 - p)
        h = np.array([[(s * x * x).sum() + penalty, (s * x).sum()], [(s * x).sum(), s.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    return a, b


def test_lines_equal_a_dense_newton_fit(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.random(300), 2)
    y = (rng.random(300) < p**2).astype(int)
    frame = spark.createDataFrame([(int(b), float(a)) for a, b in zip(p, y)], "label int, probability double")
    z = np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))
    fitted = cal.fit_sigmoid(frame)
    assert (fitted["slope"], fitted["intercept"]) == pytest.approx(_newton(z, y, np.ones(300), 1.0), abs=1e-8)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (300 - y.sum() + 2))
    fitted = linear.fit_platt(frame.withColumn("margin", logit(F.col("probability"))))
    assert (fitted["slope"], fitted["intercept"]) == pytest.approx(_newton(z, target, np.ones(300), 0.0), abs=1e-8)
    same = spark.createDataFrame([(i % 2, 0.5) for i in range(10)], "label int, probability double")
    assert cal.fit_sigmoid(same) == pytest.approx({"slope": 0.0, "intercept": 0.0}, abs=1e-9)


def test_svm_folds_are_at_the_lowest_hinge_loss(spark):
    """The loss is convex: where no direction leads down by more than a thousandth, at any step, it is at its minimum."""
    x, y, frame = _rows(spark, n=90, d=3)
    frame = frame.coalesce(1)
    fitted = linear.SvmScorer.fit(frame)
    folds = {r.email_id: r["_fold"] for r in linear.stratified_folds(frame, linear.FOLDS).collect()}
    fold = np.array([folds[str(i)] for i in range(len(y))])
    rng = np.random.default_rng(1)
    for number, model in enumerate(fitted.models):
        rows, sign = x[fold != number], 2 * y[fold != number] - 1

        def loss(v):
            return np.maximum(0, 1 - sign * (rows @ v[:-1] + v[-1])).sum() + v[:-1] @ v[:-1] / 2

        at = np.append(model.coefficients.toArray(), model.intercept)
        for step in (1.0, 0.1, 0.01, 0.001):
            for _ in range(200):
                assert loss(at + step * rng.normal(size=4)) >= loss(at) * (1 - 1e-3)


def test_an_unfinished_svm_is_an_error(spark):
    with pytest.raises(RuntimeError, match="did not converge"):
        linear.SvmScorer.fit(_rows(spark)[2], max_iter=2)
