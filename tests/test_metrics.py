"""Metrics, thresholds and calibration on small edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailsift.operators import calibration as cal, linear, metrics as M, thresholds as T


def scored(spark, y, p):
    return spark.createDataFrame(list(zip(y, map(float, p))), "label int, probability double")


def brute(y, p, thr):
    y, p = np.array(y), np.array(p, dtype=float)
    said = p >= thr
    tp, fp = int((said & (y == 1)).sum()), int((said & (y == 0)).sum())
    fn, tn = int((~said & (y == 1)).sum()), int((~said & (y == 0)).sum())
    pos, neg = p[y == 1], p[y == 0]
    roc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]) if len(pos) and len(neg) else None
    ap, last = 0.0, 0.0
    for s in sorted(set(p), reverse=True):
        hit = (p >= s)
        recall = (hit & (y == 1)).sum() / max(1, (y == 1).sum())
        ap += (recall - last) * (hit & (y == 1)).sum() / hit.sum()
        last = recall
    return dict(tn=tn, fp=fp, fn=fn, tp=tp, pr_auc=ap, roc_auc=roc, brier=float(np.mean((p - y) ** 2)))


CASES = [
    ([0, 1], [0.1, 0.9]),
    ([0, 1, 0, 1, 0, 1], [0.1, 0.9, 0.3, 0.8, 0.2, 0.95]),
    ([0, 1, 1, 0], [0.5, 0.5, 0.5, 0.5]),
    ([0, 1, 0, 1, 1], [0.0, 1.0, 0.3, 0.6, 0.7]),
    ([1, 1], [0.2, 0.8]),
]


@pytest.mark.parametrize("y,p", CASES)
def test_report_equals_brute_force(spark, y, p):
    row, want = M.report(scored(spark, y, p), 0.5).first(), brute(y, p, 0.5)
    for name, value in want.items():
        assert row[name] == value if value is None else math.isclose(row[name], value, abs_tol=1e-12), name


def test_random_scores_over_many_partitions(spark):
    rng = np.random.default_rng(1)
    p = rng.random(2000).round(3)
    y = (rng.random(2000) < p).astype(int)
    row, want = M.report(scored(spark, y.tolist(), p.tolist()).repartition(16), 0.4).first(), brute(y, p, 0.4)
    for name, value in want.items():
        assert math.isclose(row[name], value, abs_tol=1e-9), name


def test_perfect_scores_have_no_calibration_error(spark):
    hist = M.score_histogram(scored(spark, [0, 1], [0.0, 1.0]))
    assert M.ece(hist, bins=2).first()["ece"] == 0.0


def test_bins_are_closed_on_opposite_sides(spark):
    rows = spark.createDataFrame([(0.3,), (0.6,), (1.0,), (0.0,)], "p double")
    got = [tuple(r) for r in rows.select(M.left_closed_bin(F.col("p")), M.right_closed_bin(F.col("p"))).collect()]
    assert got == [(2, 2), (5, 5), (None, 9), (0, 0)]  # the float edges 3 * 0.1 and 6 * 0.1 lie above 0.3 and 0.6


def test_sweep_grid_and_monotone_recall(spark):
    table = T.threshold_sweep(scored(spark, [0, 1, 0, 1], [0.1, 0.9, 0.2, 0.8])).orderBy("threshold").collect()
    assert len(table) == 91 and table[0].threshold == 0.05 and table[-1].threshold == 0.95
    assert all(a.recall >= b.recall for a, b in zip(table, table[1:]))


def test_tie_goes_to_the_centre(spark):
    sweep = T.threshold_sweep(scored(spark, [0, 1], [0.1, 0.9]))
    best = T.choose_threshold(sweep, floor=0.95).first()
    assert best.threshold == 0.5 and best.precision == 1.0


def test_no_row_meets_the_floor(spark):
    sweep = T.threshold_sweep(scored(spark, [0, 0, 1], [0.9, 0.2, 0.3]))
    best = T.choose_threshold(sweep, floor=0.95).first()
    top = max(sweep.collect(), key=lambda r: (r.precision, r.f1, r.recall, -r.threshold))
    assert best.threshold == top.threshold


def test_every_score_meets_its_own_threshold(spark):
    grid = T.grid()
    rows = spark.createDataFrame([(t,) for t in grid] + [(0.0,), (1.0,), (0.0499,)], "p double")
    got = [r[0] for r in rows.select(T.grid_index(F.col("p"), grid)).collect()]
    assert got == list(range(1, 92)) + [0, 91, 0]


def test_calibrators_stay_in_range(spark):
    rows = scored(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])
    fitted = cal.fit_temperature(rows).first()
    assert fitted.temperature == 0.5
    after = cal.scale_by_sigmoid(rows, cal.fit_sigmoid(rows)).collect()
    assert all(0.0 <= r.prob_after <= 1.0 for r in after)


def test_sigmoid_fit_is_the_optimum(spark):
    rng = np.random.default_rng(2)
    p = rng.random(300).clip(0.01, 0.99)
    y = (rng.random(300) < p).astype(int)
    fitted = cal.fit_sigmoid(scored(spark, y.tolist(), p.tolist()))
    z = np.log(p / (1 - p))
    a, b = fitted["slope"], fitted["intercept"]
    q = 1 / (1 + np.exp(-(a * z + b)))
    assert abs(((q - y) * z).sum() + a) < 1e-2 and abs((q - y).sum()) < 1e-2  # gradient of the penalised loss


def test_platt_targets(spark):
    rows = spark.createDataFrame([(0, -1.0), (0, -0.5), (1, 0.4), (1, 2.0), (0, 0.6)], "label int, margin double")
    fitted = linear.fit_platt(rows)
    z = np.array([-1.0, -0.5, 0.4, 2.0, 0.6])
    t = np.array([1 / 5, 1 / 5, 3 / 4, 3 / 4, 1 / 5])
    q = 1 / (1 + np.exp(-(fitted["slope"] * z + fitted["intercept"])))
    assert abs((q - t).sum()) < 1e-3 and abs(((q - t) * z).sum()) < 1e-3


def test_curves_use_no_keyed_join(spark):
    rows = [(m, i % 3 == 0, (i % 7) / 10) for m in "ab" for i in range(40)]
    scored = spark.createDataFrame([(m, int(y), p) for m, y, p in rows], "model string, label int, probability double")
    prefix = M.prefix_counts(M.score_histogram(scored, ("model",)), ("model",))
    for curve, end in ((M.roc_points, (0.0, 0.0, None)), (M.pr_points, (0.0, 1.0, None))):
        points = curve(prefix, ("model",))
        plan = points._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and all("_part" in part.split(")")[0] for part in plan.split("hashpartitioning(")[1:])
        got = [tuple(r)[1:] for r in points.filter("model = 'a'").collect()]
        assert len(got) == 8 and end in got
    top = M.roc_points(prefix, ("model",)).filter("model = 'b' and threshold = 0.0").first()
    assert (top.fpr, top.tpr) == (1.0, 1.0)
