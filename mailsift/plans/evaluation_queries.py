"""Metrics, threshold sweeps and calibration over fixed scores with many ties."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift.config import PRECISION_FLOOR
from mailsift.functions import probability as prob
from mailsift.operators import audit, calibration as cal, linear, metrics as M, thresholds as T
from mailsift.plans.curation_queries import scratch
from mailsift.plans.inputs import one_model, scored, scored_lines, with_views
from mailsift.plans.registry import query, r6, rounded, s6
from mailsift.schema import PREDICTION
from mailsift.sources import tables

METRICS = ("precision", "recall", "f1", "macro_f1", "pr_auc", "roc_auc", "brier", "ece")

# ---- the metrics in SQL ------------------------------------------------------------------

SQL_F1 = "CASE WHEN 2*tp + fp + fn = 0 THEN 0e0 ELSE 2*tp / (2*tp + fp + fn) END"
_F0 = "CASE WHEN 2*tn + fp + fn = 0 THEN 0e0 ELSE 2*tn / (2*tn + fp + fn) END"
SQL_RATES = {
    "precision": "CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp) END",
    "recall": "CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn) END",
    "f1": SQL_F1,
    "macro_f1": f"(({SQL_F1}) + ({_F0})) / ((CASE WHEN tp + fp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp + fn > 0 THEN 1 ELSE 0 END))",
}


def sql_confusion(source: str, threshold: str, key: str = "model") -> str:
    return f"""SELECT {key}, count(*) FILTER (label = 0 AND p < {threshold}) AS tn, count(*) FILTER (label = 0 AND p >= {threshold}) AS fp,
      count(*) FILTER (label = 1 AND p < {threshold}) AS fn, count(*) FILTER (label = 1 AND p >= {threshold}) AS tp FROM {source} GROUP BY {key}"""


def sql_areas(source: str, key: str = "model") -> str:
    """Average precision and ROC area by definition, over distinct scores in order."""
    return f"""SELECT {key}, sum(pos / all_pos * (cum_pos / cum_n)) AS pr_auc,
      sum(pos * (all_neg - (cum_n - cum_pos) + (n - pos) / 2)) / (any_value(all_pos) * any_value(all_neg)::DOUBLE) AS roc_auc FROM (
      SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n, sum(pos) OVER (PARTITION BY {key}) AS all_pos,
        sum(n - pos) OVER (PARTITION BY {key}) AS all_neg
      FROM (SELECT {key}, p, sum(label)::BIGINT AS pos, count(*) AS n FROM {source} GROUP BY {key}, p)
      WINDOW w AS (PARTITION BY {key} ORDER BY p DESC)) GROUP BY {key}"""


def sql_ece(source: str, key: str = "model") -> str:
    edges = ", ".join(repr(i * 0.1) + "::DOUBLE" for i in range(1, 10))
    return f"""SELECT {key}, coalesce(sum(abs(y - c) * n) FILTER (bin IS NOT NULL), 0e0) / sum(n) AS ece FROM (
      SELECT {key}, bin, avg(label) AS y, avg(p) AS c, count(*) AS n FROM (
        SELECT *, CASE WHEN p >= 0 AND p < 1 THEN len(list_filter([{edges}], lambda e: p >= e)) END AS bin FROM {source}) GROUP BY {key}, bin) GROUP BY {key}"""


def sql_report(source: str, threshold: str, key: str = "model") -> str:
    return f"""SELECT c.{key}, {', '.join(f'{e} AS {n}' for n, e in SQL_RATES.items())}, a.pr_auc, a.roc_auc, b.brier, e.ece, tn, fp, fn, tp
      FROM ({sql_confusion(source, threshold, key)}) c JOIN ({sql_areas(source, key)}) a ON a.{key} = c.{key}
      JOIN (SELECT {key}, avg((p - label) * (p - label)) AS brier FROM {source} GROUP BY {key}) b ON b.{key} = c.{key}
      JOIN ({sql_ece(source, key)}) e ON e.{key} = c.{key}"""


def sql_sweep(source: str, key: str = "model") -> str:
    rates = ", ".join(f"{e} AS {n}" for n, e in SQL_RATES.items())
    return f"""SELECT s.{key}, s.threshold, {rates}, a.pr_auc, a.roc_auc, b.brier, e.ece FROM (
      SELECT {key}, t / 100e0 AS threshold, count(*) FILTER (label = 0 AND p < t / 100e0) AS tn, count(*) FILTER (label = 0 AND p >= t / 100e0) AS fp,
        count(*) FILTER (label = 1 AND p < t / 100e0) AS fn, count(*) FILTER (label = 1 AND p >= t / 100e0) AS tp
      FROM {source}, range(5, 96) g(t) GROUP BY {key}, t) s JOIN ({sql_areas(source, key)}) a ON a.{key} = s.{key}
      JOIN (SELECT {key}, avg((p - label) * (p - label)) AS brier FROM {source} GROUP BY {key}) b ON b.{key} = s.{key}
      JOIN ({sql_ece(source, key)}) e ON e.{key} = s.{key}"""


def sql_choose(sweep: str, key: str = "model") -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY precision >= 0.95e0 DESC,
      CASE WHEN precision >= 0.95e0 THEN -f1 ELSE -precision END, CASE WHEN precision >= 0.95e0 THEN -recall ELSE -f1 END,
      CASE WHEN precision >= 0.95e0 THEN abs(threshold - 0.5e0) ELSE -recall END, threshold) AS rn FROM ({sweep})) WHERE rn = 1"""


_S = "s AS (SELECT model, label, probability AS p, email_id FROM scored)"
_L = "s AS (SELECT model, label, probability AS p FROM scored_lines)"


def sql_round(columns: tuple[str, ...], names: tuple[str, ...], body: str) -> str:
    return f"SELECT {', '.join([*columns, *(f'{s6(n)} AS {n}' for n in names)])} FROM ({body})"


# ---- metrics -----------------------------------------------------------------------------


@query(with_views("scored", sql_round(("model", "tn", "fp", "fn", "tp"), ("precision", "recall", "f1", "macro_f1"),
    f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in SQL_RATES.items())} FROM ({sql_confusion('s', '0.6e0')})"), _S))
def confusion_and_rates(spark, sf_dir):
    """Confusion counts, precision, recall, F1 and macro F1 at a threshold."""
    counted = M.with_rates(M.confusion(scored(spark, sf_dir), 0.6, ("model",)))
    return rounded(counted, "precision", "recall", "f1", "macro_f1")


@query(with_views("scored", sql_round(("model",), ("pr_auc", "roc_auc"), sql_areas("s")), _S))
def ranking_areas(spark, sf_dir):
    """Average precision and ROC area with ties."""
    prefix = M.prefix_counts(M.score_histogram(scored(spark, sf_dir), ("model",)), ("model",))
    return rounded(M.ranking_areas(prefix, ("model",)), "pr_auc", "roc_auc")


@query(with_views("scored_lines", sql_round(("model",), ("pr_auc", "roc_auc"), sql_areas("s")), _L))
def ranking_areas_of_lines(spark, sf_dir):
    """The same areas over every order line, where hardly any score ties."""
    prefix = M.prefix_counts(M.score_histogram(scored_lines(spark, sf_dir), ("model",)), ("model",))
    return rounded(M.ranking_areas(prefix, ("model",)), "pr_auc", "roc_auc")


@query(with_views("scored", sql_round(("model",), ("brier", "ece"),
    f"SELECT b.model, brier, ece FROM (SELECT model, avg((p - label) * (p - label)) AS brier FROM s GROUP BY model) b JOIN ({sql_ece('s')}) e ON b.model = e.model"), _S))
def brier_and_ece(spark, sf_dir):
    """Brier score, and calibration error over ten left-closed bins."""
    rows = scored(spark, sf_dir)
    error = M.ece(M.score_histogram(rows, ("model",)), ("model",))
    return rounded(M.brier(rows, ("model",)).join(error, "model"), "brier", "ece")


@query(with_views("scored", sql_round(("model", "tn", "fp", "fn", "tp"), METRICS, sql_report("s", "0.5e0")), _S))
def full_report(spark, sf_dir):
    """All eight metrics and the confusion counts per model."""
    return rounded(M.report(scored(spark, sf_dir), 0.5, ("model",)), *METRICS)


@query(with_views("scored_lines", sql_round(("model", "tn", "fp", "fn", "tp"), METRICS, sql_report("s", "0.5e0")), _L))
def full_report_of_lines(spark, sf_dir):
    """The same report over every order line."""
    return rounded(M.report(scored_lines(spark, sf_dir), 0.5, ("model",)), *METRICS)


@query(with_views("scored", f"""SELECT model, {s6('fpr')} AS fpr, {s6('tpr')} AS tpr, threshold FROM (
  SELECT model, cum_neg / sum(neg) OVER (PARTITION BY model) AS fpr, cum_pos / sum(pos) OVER (PARTITION BY model) AS tpr, p AS threshold FROM (
    SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg
    FROM (SELECT model, p, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY ALL) WINDOW w AS (PARTITION BY model ORDER BY p DESC))
  UNION ALL SELECT DISTINCT model, 0, 0, NULL FROM s)""", _S))
def roc_curve(spark, sf_dir):
    """False and true positive rate at every distinct score."""
    prefix = M.prefix_counts(M.score_histogram(scored(spark, sf_dir), ("model",)), ("model",))
    return rounded(M.roc_points(prefix, ("model",)), "fpr", "tpr")


@query(with_views("scored", f"""SELECT model, {s6('recall')} AS recall, {s6('precision')} AS precision, threshold FROM (
  SELECT model, cum_pos / sum(pos) OVER (PARTITION BY model) AS recall, cum_pos / cum_n AS precision, p AS threshold FROM (
    SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n
    FROM (SELECT model, p, sum(label) AS pos, count(*) AS n FROM s GROUP BY ALL) WINDOW w AS (PARTITION BY model ORDER BY p DESC))
  UNION ALL SELECT DISTINCT model, 0, 1, NULL FROM s)""", _S))
def precision_recall_curve(spark, sf_dir):
    """Precision and recall at every distinct score."""
    prefix = M.prefix_counts(M.score_histogram(scored(spark, sf_dir), ("model",)), ("model",))
    return rounded(M.pr_points(prefix, ("model",)), "recall", "precision")


_EDGES = ", ".join(repr(i * 0.1) + "::DOUBLE" for i in range(1, 10))


@query(with_views("scored", f"""SELECT model, CAST(bin AS INTEGER) AS bin, {s6('avg(p)')} AS prob_pred, {s6('avg(label)')} AS prob_true, count(*) AS n FROM (
  SELECT *, len(list_filter([{_EDGES}], lambda e: p > e)) AS bin FROM s) GROUP BY model, bin""", _S))
def reliability(spark, sf_dir):
    """Mean score and share of positives in ten right-closed bins."""
    curve = M.reliability_curve(M.score_histogram(scored(spark, sf_dir), ("model",)), ("model",))
    return rounded(curve, "prob_pred", "prob_true")


# ---- thresholds --------------------------------------------------------------------------


@query(with_views("scored", sql_round(("model", "threshold"), METRICS, sql_sweep("s")), _S))
def threshold_sweep(spark, sf_dir):
    """91 thresholds per model from one pass over the scores."""
    return rounded(T.threshold_sweep(scored(spark, sf_dir), ("model",)), *METRICS)


@query(with_views("scored_lines", sql_round(("model", "threshold"), METRICS, sql_sweep("s")), _L))
def threshold_sweep_of_lines(spark, sf_dir):
    """The same sweep over every order line."""
    return rounded(T.threshold_sweep(scored_lines(spark, sf_dir), ("model",)), *METRICS)


@query(with_views("scored", sql_round(("model", "threshold"), METRICS, sql_choose(sql_sweep("s"))), _S))
def chosen_threshold(spark, sf_dir):
    """The threshold under the precision floor, per model."""
    return rounded(T.choose_threshold(T.threshold_sweep(scored(spark, sf_dir), ("model",)), ("model",)), *METRICS)


_TEMPER = "1e0 / (1e0 + exp(-(ln({c} / (1e0 - {c})) / {t})))"
_CLIP = "least(greatest({p}, 1e-6), 1e0 - 1e-6)"


def sql_temper(p: str, t: str) -> str:
    return _TEMPER.format(c=_CLIP.format(p=p), t=t)


# Fixed value: a temperature for the stand-in calibrated scores of the sharp model.
_T = 0.65


@query(with_views("scored", f"""SELECT model, threshold AS selected_threshold, {s6('precision')} AS best_precision, {s6('recall')} AS best_recall, {s6('f1')} AS best_f1
  FROM ({sql_choose(sql_sweep('c'))})""", f"""c AS (SELECT model, label,
    CASE WHEN model = 'sharp' THEN floor(({sql_temper('probability', '0.65e0')}) * 1e4 + 0.5e0) / 1e4 ELSE probability END AS p FROM scored)"""))
def threshold_analysis(spark, sf_dir):
    """Chosen threshold per model, from calibrated scores where there are any."""
    tempered = F.floor(prob.apply_temperature(F.col("probability"), _T) * 1e4 + 0.5) / 1e4
    rows = scored(spark, sf_dir).withColumn("prob_after", F.when(F.col("model") == "sharp", tempered))
    return rounded(T.threshold_analysis(rows), "best_precision", "best_recall", "best_f1")


# ---- calibration -------------------------------------------------------------------------


@query(with_views("one_model", f"""SELECT email_id, {s6('z')} AS logit, {s6(sql_temper('probability', '1.7e0'))} AS tempered,
  {s6('1e0 / (1e0 + exp(-(1.3e0 * z - 0.4e0)))')} AS sigmoided
  FROM (SELECT *, ln({_CLIP.format(p='probability')} / (1e0 - {_CLIP.format(p='probability')})) AS z FROM one_model)"""))
def calibration_curves(spark, sf_dir):
    """Logits of clipped scores, and both calibration curves with given parameters."""
    p = F.col("probability")
    return one_model(spark, sf_dir).select(
        "email_id", r6(prob.logit(p)).alias("logit"), r6(prob.apply_temperature(p, 1.7)).alias("tempered"),
        r6(prob.apply_sigmoid(p, 1.3, -0.4)).alias("sigmoided"),
    )


_LOSSES = f"""losses AS (SELECT model, temperature, avg(-(label * ln(q) + (1 - label) * ln(1e0 - q))) AS loss FROM (
  SELECT model, label, 0.5e0 + i * 0.05e0 AS temperature, {sql_temper('probability', '(0.5e0 + i * 0.05e0)')} AS q
  FROM scored, range(0, 91) g(i)) GROUP BY model, temperature)"""
_FITTED = "fitted AS (SELECT model, temperature, loss FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY loss, temperature) AS rn FROM losses) WHERE rn = 1)"


@query(with_views("scored", f"SELECT model, {s6('temperature')} AS temperature, {s6('loss')} AS loss FROM losses", _LOSSES))
def temperature_losses(spark, sf_dir):
    """Mean log-loss of every candidate temperature."""
    return rounded(cal.temperature_losses(scored(spark, sf_dir), ("model",)), "temperature", "loss")


@query(with_views("scored", f"SELECT model, {s6('temperature')} AS temperature, {s6('loss')} AS loss FROM fitted", _LOSSES + ", " + _FITTED))
def fitted_temperature(spark, sf_dir):
    """The temperature of least loss per model."""
    return rounded(cal.fit_temperature(scored(spark, sf_dir), ("model",)), "temperature", "loss")


@query(with_views("scored", f"""SELECT email_id, label AS y_true, probability AS prob_before, {s6(sql_temper('probability', 'temperature'))} AS prob_after
  FROM scored s JOIN fitted f ON s.model = f.model WHERE s.model = 'sharp'""", _LOSSES + ", " + _FITTED))
def calibrated_scores(spark, sf_dir):
    """Scores before and after fitted temperature scaling."""
    rows = one_model(spark, sf_dir)
    return rounded(cal.calibrated_table(cal.scale_by_temperature(rows, cal.fit_temperature(rows))), "prob_after")


def _tempered(spark, sf_dir):
    rows = one_model(spark, sf_dir)
    return cal.scale_by_temperature(rows, cal.fit_temperature(rows))


_STAGES = f"""{_LOSSES}, {_FITTED}, t AS (
  SELECT s.*, {sql_temper('probability', 'temperature')} AS prob_after FROM scored s JOIN fitted f ON s.model = f.model WHERE s.model = 'sharp'),
  s AS (SELECT 'before' AS model, label, probability AS p FROM t UNION ALL SELECT 'after', label, prob_after FROM t)"""


@query(with_views("scored", f"""SELECT 'sharp' AS model, 'temperature' AS calibration_type, {', '.join(
    f"{s6(f'max({m}) FILTER (model = {chr(39)}{st}{chr(39)})')} AS {m}_{st}" for m in ('brier', 'ece', 'pr_auc') for st in ('before', 'after'))}
  FROM ({sql_report('s', '0.5e0')})""", _STAGES))
def calibration_comparison(spark, sf_dir):
    """Brier, calibration error and average precision before and after."""
    names = [f"{m}_{s}" for m in ("brier", "ece", "pr_auc") for s in ("before", "after")]
    return rounded(cal.before_after(_tempered(spark, sf_dir), "sharp", "temperature"), *names)


def sql_line(rows: str, penalty: float, steps: int = 15) -> str:
    """CTEs ending in ``line (a, b)``: Newton steps of a logistic curve over ``rows (x, t)``, written out one by one."""
    out = ["n0 AS (SELECT 0e0 AS a, 0e0 AS b)"]
    for i in range(steps):
        p = "(1e0 / (1e0 + exp(-(a * x + b))))"
        out.append(f"""m{i} AS MATERIALIZED (SELECT any_value(a) AS a, any_value(b) AS b, sum(({p} - t) * x) + {penalty}e0 * any_value(a) AS ga, sum({p} - t) AS gb,
          sum({p} * (1e0 - {p}) * x * x) + {penalty}e0 AS aa, sum({p} * (1e0 - {p}) * x) AS ab, sum({p} * (1e0 - {p})) AS bb FROM {rows}, n{i})""")
        out.append(f"n{i + 1} AS MATERIALIZED (SELECT a - (bb * ga - ab * gb) / (aa * bb - ab * ab) AS a, b - (aa * gb - ab * ga) / (aa * bb - ab * ab) AS b FROM m{i})")
    return ", ".join(out) + f", line AS (SELECT * FROM n{steps})"


_LOGIT = "ln(greatest(1e-6, least(1e0 - 1e-6, probability)) / (1e0 - greatest(1e-6, least(1e0 - 1e-6, probability))))"
_SIGMOID_FIT = f"rows AS (SELECT {_LOGIT} AS x, label::DOUBLE AS t FROM one_model), " + sql_line("rows", 1)
_PLATT_FIT = f"""counts AS (SELECT count_if(label = 1) AS n1, count_if(label = 0) AS n0 FROM one_model),
  rows AS (SELECT {_LOGIT} AS x, CASE WHEN label = 1 THEN (n1 + 1e0) / (n1 + 2e0) ELSE 1e0 / (n0 + 2e0) END AS t FROM one_model, counts), """ + sql_line("rows", 0)


@query(with_views("one_model", f"""SELECT email_id, label AS y_true, probability AS prob_before,
  {s6(f"1e0 / (1e0 + exp(-(a * {_LOGIT} + b)))")} AS prob_after FROM one_model, line""", _SIGMOID_FIT))
def sigmoid_calibration(spark, sf_dir):
    """Scores before and after a fitted sigmoid; SQL takes the same Newton steps."""
    rows = one_model(spark, sf_dir)
    return rounded(cal.calibrated_table(cal.scale_by_sigmoid(rows, cal.fit_sigmoid(rows))), "prob_after")


@query(with_views("one_model", f"SELECT {s6('a')} AS slope, {s6('b')} AS intercept FROM line", _PLATT_FIT))
def platt_scaling(spark, sf_dir):
    """Slope and intercept of the unpenalised sigmoid with Platt's smoothed targets."""
    rows = one_model(spark, sf_dir).withColumn("margin", prob.logit(F.col("probability")))
    fitted = spark.createDataFrame([linear.fit_platt(rows)], "slope double, intercept double")
    return rounded(fitted, "slope", "intercept")


_BY_MODEL = f"""{_STAGES.rsplit(', t AS', 1)[0]}, t AS (SELECT s.*, {sql_temper('probability', 'temperature')} AS prob_after FROM scored s JOIN fitted f ON s.model = f.model WHERE s.model = 'sharp'),
  rows AS (SELECT {_LOGIT} AS x, label::DOUBLE AS t FROM scored WHERE model = 'blunt'), {sql_line("rows", 1)},
  pairs AS (SELECT model, label, probability, prob_after FROM t UNION ALL
    SELECT model, label, probability, 1e0 / (1e0 + exp(-(a * {_LOGIT} + b))) FROM scored, line WHERE model = 'blunt'),
  s AS (SELECT model || '/before' AS model, label, probability AS p FROM pairs UNION ALL SELECT model || '/after', label, prob_after FROM pairs)"""


@query(with_views("scored", f"""SELECT split_part(model, '/', 1) AS model, CASE split_part(model, '/', 1) WHEN 'sharp' THEN 'temperature' ELSE 'sigmoid' END AS calibration_type, {', '.join(
    f"{s6(f'max({m}) FILTER (ends_with(model, {chr(39)}/{st}{chr(39)}))')} AS {m}_{st}" for m in ('brier', 'ece', 'pr_auc') for st in ('before', 'after'))}
  FROM ({sql_report('s', '0.5e0')}) GROUP BY 1, 2""", _BY_MODEL))
def calibration_by_model(spark, sf_dir):
    """Before and after for a model with a temperature and one with a sigmoid, a row each."""
    names = [f"{m}_{s}" for m in ("brier", "ece", "pr_auc") for s in ("before", "after")]
    blunt = one_model(spark, sf_dir, "blunt")
    sigmoid = cal.before_after(cal.scale_by_sigmoid(blunt, cal.fit_sigmoid(blunt)), "blunt", "sigmoid")
    return rounded(cal.before_after(_tempered(spark, sf_dir), "sharp", "temperature").union(sigmoid), *names)


# ---- gates and sinks ---------------------------------------------------------------------


@query(with_views("scored", f"""SELECT 'ece' AS "check", CASE WHEN a.ece <= b.ece + 1e-12 THEN 'PASS' ELSE 'FAIL' END AS level, {s6('a.ece - b.ece')} AS value FROM r a, r b WHERE a.model = 'after' AND b.model = 'before'
  UNION ALL SELECT 'brier', CASE WHEN a.brier <= b.brier + 1e-12 THEN 'PASS' ELSE 'WARN' END, {s6('a.brier - b.brier')} FROM r a, r b WHERE a.model = 'after' AND b.model = 'before'""",
  _STAGES + f", r AS ({sql_report('s', '0.5e0')})"))
def calibration_gates(spark, sf_dir):
    """Calibration must not raise ECE (fail) or Brier (warn)."""
    rows = _tempered(spark, sf_dir)
    raw = M.report(rows, 0.5)
    calibrated = M.report(rows.drop("probability").withColumnRenamed("prob_after", "probability"), 0.5)
    return audit.calibration_checks(raw, calibrated).withColumn("value", r6("value"))


_GATES = f"""v AS (SELECT 'sharp' AS model, label, p FROM s WHERE model = 'sharp'), c AS ({sql_choose(sql_sweep('v'))}),
  r AS ({sql_report('t', '(SELECT threshold FROM c)')})"""


@query(with_views("scored", f"""SELECT 'grid_rows' AS "check", 'PASS' AS level, 91e0 AS value
  UNION ALL SELECT 'selected_threshold', CASE WHEN threshold BETWEEN 0.05e0 AND 0.95e0 THEN 'PASS' ELSE 'FAIL' END, {s6('threshold')} FROM c
  UNION ALL SELECT 'valid_precision', CASE WHEN precision >= 0.95e0 THEN 'PASS' ELSE 'FAIL' END, {s6('precision')} FROM c
  UNION ALL SELECT 'test_precision', 'PASS', {s6('precision')} FROM r UNION ALL SELECT 'test_recall', 'PASS', {s6('recall')} FROM r
  UNION ALL SELECT 'test_f1', 'PASS', {s6('f1')} FROM r UNION ALL SELECT 'test_macro_f1', 'PASS', {s6('macro_f1')} FROM r""",
  _S + ", t AS (SELECT 'blunt' AS model, label, p FROM s WHERE model = 'blunt'), " + _GATES))
def metric_gates(spark, sf_dir):
    """Checks of the chosen threshold on one model's scores and of the other's metrics at it."""
    sweep = T.threshold_sweep(one_model(spark, sf_dir, "sharp"))
    chosen = T.choose_threshold(sweep, floor=PRECISION_FLOOR)
    test = one_model(spark, sf_dir, "blunt")
    at = chosen.select("threshold").scalar()
    prefix = M.prefix_counts(M.score_histogram(test)).withColumn("_at", at)
    at_chosen = M.report_from_prefix(prefix, F.col("_at"))
    return audit.threshold_checks(sweep, chosen, at_chosen, PRECISION_FLOOR).withColumn("value", r6("value"))


@query(with_views("scored", sql_round(("model", "tn", "fp", "fn", "tp"), METRICS, sql_report("s", "0.5e0")), _S))
def report_round_trip(spark, sf_dir):
    """A metric report written as JSON and read back with its schema."""
    path, found = scratch(spark, "report"), full_report(spark, sf_dir)
    tables.write_report(found, path)
    return tables.read_report(spark, path, found.schema)


@query(with_views("one_model", "SELECT email_id, label, source_dataset, probability, CASE WHEN probability >= 0.5e0 THEN 1 ELSE 0 END AS pred_label FROM one_model"))
def prediction_round_trip(spark, sf_dir):
    """Predictions at 0.5 written and read back with the declared schema."""
    from mailsift.operators.scoring import predictions

    path = scratch(spark, "predictions")
    tables.write_table(predictions(one_model(spark, sf_dir)), path)
    return spark.read.schema(PREDICTION).parquet(path)


