"""Linear fits reach their optimum, whatever the partitions; folds hold every class."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from mailsift.operators import curate, linear


def _rows(spark, n=240, d=6):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, d))
    y = (x @ rng.normal(size=d) + rng.normal(scale=1.5, size=n) > 0.8).astype(int)
    frame = spark.createDataFrame([(str(i), int(y[i]), Vectors.dense(x[i])) for i in range(n)], ["email_id", "label", "features"])
    return x, y, frame


def test_logistic_gradient_vanishes_and_partitions_do_not_matter(spark):
    x, y, frame = _rows(spark)
    weight = len(y) / (2.0 * np.bincount(y))[y]
    fits = [
        linear.fit_logistic(linear.with_class_weight(frame.repartition(n)), weight="weight") for n in (1, 7)
    ]
    for model in fits:
        w, b = model.coefficients.toArray(), model.intercept
        error = weight * (1.0 / (1.0 + np.exp(-(x @ w + b))) - y)
        gradient = np.append(x.T @ error + w, error.sum())
        assert np.abs(gradient).max() / weight.sum() < 1e-5
    assert np.allclose(fits[0].coefficients.toArray(), fits[1].coefficients.toArray(), atol=1e-5)


def test_an_unfinished_fit_is_an_error(spark):
    frame = _rows(spark)[2]
    with pytest.raises(RuntimeError, match="did not converge"):
        linear.fit_logistic(frame, max_iter=2)


def test_folds_are_stratified(spark):
    frame = spark.createDataFrame([(str(i), int(i % 10 == 0)) for i in range(200)], ["email_id", "label"])
    folded = curate.stratified_folds(frame, 3)
    assert folded.count() == 200
    sizes = {(r["label"], r["_fold"]): r["count"] for r in folded.groupBy("label", "_fold").count().collect()}
    assert sorted(n for (label, _), n in sizes.items() if label == 1) == [6, 7, 7]
    assert sorted(n for (label, _), n in sizes.items() if label == 0) == [60, 60, 60]
    with pytest.raises(ValueError, match="fewer rows"):
        curate.stratified_folds(frame.filter("label = 0 or email_id = '0'"), 3)


def test_saved_models_score_alike(spark, tmp_path):
    frame = _rows(spark, n=60, d=2)[2].coalesce(1)
    scorers = [linear.LogisticScorer(linear.fit_logistic(frame)), linear.SvmScorer.fit(frame, tol=0.05)]
    for kind, scorer in zip(("logistic", "svm"), scorers):
        facts = scorer.save(str(tmp_path / kind))
        again = linear.SCORERS[facts["kind"]].load(str(tmp_path / kind), facts)
        before, after = (
            [r["probability"] for r in s.score(frame).orderBy("email_id").select("probability").collect()] for s in (scorer, again)
        )
        assert np.allclose(before, after, atol=1e-12)


def test_rare_terms_do_not_slow_a_fit(spark):
    """Terms of very uneven frequency, as in text: the optimum is a hundred steps away, not a thousand."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):
        places = np.unique((3000 * rng.random(60) ** 4).astype(int))
        values = rng.random(len(places)) + 0.1
        rows.append((str(i), i % 2, Vectors.sparse(3001, [*places, 3000], [*(values / np.linalg.norm(values)), 0.1 * (i % 2)])))
    frame = spark.createDataFrame(rows, ["email_id", "label", "features"])
    model = linear.fit_logistic(frame, max_iter=100)
    x, y = np.stack([r[2].toArray() for r in rows]), np.array([r[1] for r in rows])
    error = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept))) - y
    assert np.abs(np.append(x.T @ error + model.coefficients.toArray(), error.sum())).max() < 1e-3


def test_hinge_fits_of_text_take_a_hundred_passes(spark):
    """Uneven terms and labels that they hardly tell: no fold's loss can be lowered, and none takes hundreds of steps."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        places = np.unique((3000 * rng.random(60) ** 4).astype(int))
        values = rng.random(len(places)) + 0.1
        rows.append((str(i), int(rng.random() < 0.2), Vectors.sparse(3000, [*places], [*(values / np.linalg.norm(values))])))
    frame = linear.with_class_weight(spark.createDataFrame(rows, ["email_id", "label", "features"])).coalesce(2)
    fitted = linear.SvmScorer.fit(frame, weight="weight", max_iter=120)
    folds = {r.email_id: r["_fold"] for r in linear.stratified_folds(frame, linear.FOLDS).collect()}
    weights = {r.email_id: r.weight for r in frame.select("email_id", "weight").collect()}
    for number, model in enumerate(fitted.models):
        kept = [r for r in rows if folds[r[0]] != number]
        x, sign, weight = np.stack([r[2].toArray() for r in kept]), np.array([2 * r[1] - 1 for r in kept]), np.array([weights[r[0]] for r in kept])

        def loss(v):
            return weight @ np.maximum(0, 1 - sign * (x @ v[:-1] + v[-1])) + v[:-1] @ v[:-1] / 2

        at = np.append(model.coefficients.toArray(), model.intercept)
        short = 1 - sign * (x @ at[:-1] + at[-1])
        slopes = [np.append(at[:-1] - x.T @ (weight * sign * (short > edge)), -(weight * sign * (short > edge)).sum()) for edge in (-0.1, 0.0, 0.1)]
        for direction in [*slopes, *rng.normal(size=(50, len(at)))]:
            for step in (1e-1, 1e-2, 1e-3, 1e-4, 1e-5):
                assert loss(at - step * direction) >= loss(at) * (1 - 1e-3)
