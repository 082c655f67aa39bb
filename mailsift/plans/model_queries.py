"""Classifiers, error analysis, scoring and streaming over the labelled mail.

Naive Bayes is all aggregates, so SQL checks it and everything built on its scores. The
iterative fits have no SQL twin and are checked by rows alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F, types as T

from mailsift.functions import probability as prob, text as X
from mailsift.functions.patterns import ERROR_TYPES, RISK_LEVELS
from mailsift.operators import bayes, calibration as cal, certificates, curate, explain, linear, metrics as M, scoring as S, vectors as V
from mailsift.plans.curation_queries import scratch
from mailsift.plans.deployment import deploy
from mailsift.plans.evaluation_queries import METRICS, _FITTED, _LOSSES, sql_report, sql_round, sql_temper
from mailsift.plans.inputs import emails, labelled, with_views
from mailsift.plans.registry import query, r6, rounded, s6, table
from mailsift.plans.text_queries import sql_body_hash
from mailsift.plans.training import compare_imbalance, train_models
from mailsift.plans.vector_queries import _TRAIN_FIT
from mailsift.session import written
from mailsift.streaming.scoring import mail_stream, score_stream

# ---- naive Bayes in SQL ------------------------------------------------------------------

_NB_FIT = f"""{_TRAIN_FIT},
  sums AS (SELECT term, sum(CASE WHEN label = 0 THEN weight ELSE 0e0 END) AS w0, sum(CASE WHEN label = 1 THEN weight ELSE 0e0 END) AS w1
    FROM weights w JOIN train t ON w.email_id = t.email_id GROUP BY term),
  totals AS (SELECT sum(w0) AS t0, sum(w1) AS t1, count(*) AS v FROM sums),
  model AS (SELECT term, ln((w1 + 0.5e0) / (t1 + 0.5e0 * v)) - ln((w0 + 0.5e0) / (t0 + 0.5e0 * v)) AS log_ratio FROM sums, totals),
  prior AS (SELECT ln((count(*) FILTER (label = 1)) / (count(*) FILTER (label = 0))) AS p FROM train),
  evidence AS (SELECT email_id, sum(weight * log_ratio) AS e FROM weights w JOIN model m ON w.term = m.term GROUP BY email_id)"""


def _nb_scores(source: str) -> str:
    """CTE ``scores``: every row of ``source`` with its naive Bayes probability."""
    return f"""scores AS (SELECT l.*, 1e0 / (1e0 + exp(-((SELECT p FROM prior) + coalesce(e, 0e0)))) AS probability
      FROM {source} l LEFT JOIN evidence v ON l.email_id = v.email_id)"""


def _weights(spark, sf_dir):
    mail = labelled(spark, sf_dir).select("email_id", "label", "split", "source_dataset", "clean_text")
    return mail, V.tfidf(mail, V.fit_vocabulary(mail.filter(F.col("split") == "train")), keep=("label", "split"))


def _nb(spark, sf_dir):
    mail, weights = _weights(spark, sf_dir)
    train = F.col("split") == "train"
    return mail, weights, bayes.fit_naive_bayes(weights.filter(train), mail.filter(train))


def nb_scores(spark, sf_dir):
    mail, weights, model = _nb(spark, sf_dir)
    return bayes.score_naive_bayes(weights, model, mail.select("email_id", "label", "split", "source_dataset"))


@query(with_views("labelled", f"SELECT term, {s6('log_ratio')} AS log_ratio, {s6('(SELECT p FROM prior)')} AS log_prior FROM model", _NB_FIT))
def naive_bayes_model(spark, sf_dir):
    """Log ratio per term and the prior, fitted on the train split."""
    return rounded(_nb(spark, sf_dir)[2], "log_ratio", "log_prior")


@query(with_views("labelled", f"SELECT email_id, label, source_dataset, {s6('probability')} AS probability, CASE WHEN probability >= 0.5e0 THEN 1 ELSE 0 END AS pred_label FROM scores",
                  _NB_FIT + ", " + _nb_scores("labelled")))
def naive_bayes_scores(spark, sf_dir):
    """Probability and decision of every labelled mail, by aggregates and joins."""
    return rounded(S.predictions(nb_scores(spark, sf_dir)), "probability")


@query(with_views("labelled", f"SELECT label, count(*) AS n, {s6('(SELECT count(*) FROM labelled) / (2 * count(*))')} AS weight FROM labelled GROUP BY label"))
def balanced_weights(spark, sf_dir):
    """Balanced class weights."""
    return rounded(linear.class_weights(labelled(spark, sf_dir)), "weight")


@query(with_views("labelled", sql_round(("model", "tn", "fp", "fn", "tp"), METRICS, sql_report("s", "0.5e0")),
                  _NB_FIT + ", " + _nb_scores("labelled") + ", s AS (SELECT 'naive_bayes/' || split AS model, label, probability AS p FROM scores)"))
def naive_bayes_report(spark, sf_dir):
    """All metrics of the naive Bayes scores per split."""
    rows = nb_scores(spark, sf_dir).withColumn("model", F.concat(F.lit("naive_bayes/"), "split"))
    return rounded(M.report(rows, 0.5, ("model",)), *METRICS)


# ---- the deployed model in vector form ---------------------------------------------------


def _nb_bundle(spark, sf_dir, calibrator: dict | None = None) -> S.MailModel:
    """Vectoriser and naive Bayes fitted on the train split."""
    train = labelled(spark, sf_dir).filter(F.col("split") == "train").select("email_id", "label", "clean_text")
    features = V.vectoriser(V.fit_vocabulary(train))
    vectors = written(features.transform(train).select("features", "label"), "vectors")
    return S.MailModel(features, linear.BayesScorer.fit(vectors), calibrator or {})


_RISK_SQL = """CASE WHEN probability >= 0.84e0 THEN 1 ELSE 0 END AS pred,
  CASE WHEN probability < 0.3e0 THEN 'safe' WHEN probability < 0.7e0 THEN 'suspicious' ELSE 'spam' END AS risk_code"""
_RISK_NAMES = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in RISK_LEVELS.items())

# The vocabulary is the training mail's, the scored mail is all of it.
_ALL_COUNTS = """ac AS (SELECT email_id, term, count(*) AS tf FROM (
    SELECT email_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
    FROM (SELECT email_id, regexp_extract_all(lower(clean_text), '[\\p{L}\\p{N}_]{2,}') AS t FROM emails)) GROUP BY ALL),
  aw AS (SELECT email_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY email_id)) AS weight FROM (
    SELECT c.email_id, c.term, c.tf * v.idf AS w FROM ac c JOIN vocabulary v ON c.term = v.term)),
  ae AS (SELECT email_id, sum(weight * log_ratio) AS e FROM aw JOIN model m ON aw.term = m.term GROUP BY email_id),
  scores AS (SELECT l.*, 1e0 / (1e0 + exp(-((SELECT p FROM prior) + coalesce(e, 0e0)))) AS probability FROM emails l LEFT JOIN ae v ON l.email_id = v.email_id)"""
_ALL_SCORES = _NB_FIT + ", " + _ALL_COUNTS
_SCORED_SQL = f"SELECT email_id, {s6('probability')} AS probability, {_RISK_SQL} FROM scores"


@query(with_views("labelled", f"SELECT *, CASE risk_code {_RISK_NAMES} END AS risk FROM ({_SCORED_SQL})", _ALL_SCORES))
def scored_mail(spark, sf_dir):
    """Every mail scored by the saved and reloaded model, with decision and risk."""
    path = scratch(spark, "model")
    _nb_bundle(spark, sf_dir).save(path)
    scored = S.MailModel.load(path).score(emails(spark, sf_dir).select("email_id", "clean_text"))
    return rounded(scored.select("email_id", "probability", "pred", "risk", "risk_code"), "probability")


@query(with_views("labelled", f"SELECT email_id, {s6(sql_temper('probability', '1.4e0'))} AS probability, {_RISK_SQL.replace('probability', sql_temper('probability', '1.4e0'))} FROM scores", _ALL_SCORES))
def calibrated_scored_mail(spark, sf_dir):
    """Every mail scored with a temperature in the model bundle."""
    scored = _nb_bundle(spark, sf_dir, {"temperature": 1.4}).score(emails(spark, sf_dir).select("email_id", "clean_text"))
    return rounded(scored.select("email_id", "probability", "pred", "risk_code"), "probability")


@query(with_views("labelled", f"""SELECT email_id AS "Id", md5(text) AS text_md5, {s6('probability')} AS probability, CASE risk_code {_RISK_NAMES} END AS risk
  FROM (SELECT *, {_RISK_SQL} FROM scores)""", _ALL_SCORES))
def scored_table(spark, sf_dir):
    """A table scored in place: the text column is found by its header."""
    mail = emails(spark, sf_dir).select(F.col("email_id").alias("Id"), F.col("text").alias("Message"))
    scored = S.score_table(mail, _nb_bundle(spark, sf_dir))
    return rounded(scored.select("Id", F.md5("Message").alias("text_md5"), "probability", "risk"), "probability")


@query(with_views("labelled", f"SELECT {s6('avg(probability)')} AS mean_probability, count(*) AS rows FROM scores", _ALL_SCORES))
def batch_summary(spark, sf_dir):
    """Mean probability and size of a scored batch."""
    return rounded(S.batch_summary(_nb_bundle(spark, sf_dir).score(emails(spark, sf_dir))), "mean_probability")


@query(with_views("labelled", _SCORED_SQL, _ALL_SCORES))
def streamed_mail(spark, sf_dir):
    """Every document read as a file stream, scored, appended to a sink and read back."""
    schema = table(spark, sf_dir, "documents").schema
    stream = mail_stream(spark, f"{sf_dir}/documents.parque[t]", schema)  # a pattern, as the table is one file or a folder of files
    from mailsift.plans.inputs import as_mail

    sink, state = scratch(spark, "stream-sink"), scratch(spark, "stream-state")
    score_stream(as_mail(stream).select("email_id", "clean_text"), _nb_bundle(spark, sf_dir), sink, state).awaitTermination()
    back = spark.read.schema("email_id string, probability double, pred int, risk string, risk_code string").parquet(sink)
    return rounded(back.select("email_id", "probability", "pred", "risk_code"), "probability")


_HISTORY_SQL = f"""SELECT ts, 'csv_batch' AS mode, {s6('probability')} AS probability, CASE risk_code {_RISK_NAMES} END AS risk, text_preview FROM (
    SELECT epoch_us(e.ts) AS ts, s.probability, substr(s.clean_text, 1, 120) AS text_preview, {_RISK_SQL.replace('probability', 's.probability')}
    FROM scores s JOIN events e ON s.email_id = CAST(e.event_id % (SELECT count(*) FROM emails) AS VARCHAR) ORDER BY e.ts DESC, text_preview LIMIT 500)"""


@query(with_views("labelled", _HISTORY_SQL, _ALL_SCORES))
def scoring_history(spark, sf_dir):
    """The newest 500 entries of a log of all events: each has the mail of its number modulo the number of mails."""
    path = scratch(spark, "history")
    mail = emails(spark, sf_dir).select("email_id", "clean_text")
    events = table(spark, sf_dir, "events").select(
        (F.col("event_id") % F.lit(mail.count())).cast("string").alias("email_id"), F.col("ts").alias("seen")
    )
    scored = _nb_bundle(spark, sf_dir).score(mail).join(events, "email_id")
    S.append_history(S.history_entries(scored, F.col("seen"), S.MODE_BATCH), path)
    recent = S.recent_history(spark.read.parquet(path))
    return rounded(recent.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp"))), "probability")


# ---- errors ------------------------------------------------------------------------------


def _errors(spark, sf_dir):
    """Naive Bayes scores joined to their mail, at the median-like threshold 0.1."""
    scored = cal.calibrated_table(nb_scores(spark, sf_dir).withColumn("prob_after", F.col("probability")))
    mail = labelled(spark, sf_dir).withColumn("has_html", F.col("clean_text").contains("<html"))
    return explain.join_predictions(scored, mail, 0.1)


_TEXT = "lower(subject || ' ' || clean_text)"
_WORDS = f"len(regexp_extract_all({_TEXT}, '[^\\s\\p{{Z}}]+'))"


def _sql_any(words) -> str:
    return "(" + " OR ".join(f"contains({_TEXT}, '{w}')" for w in words) + ")"


_MARKETING = ("free", "winner", "offer", "urgent", "discount")
_CODE_SQL = f"""CASE WHEN label = 0 AND pred_label = 1 THEN CASE WHEN {_sql_any(_MARKETING)} THEN 'fp_marketing'
    WHEN {_sql_any(('system', 'notification', 'alert', 'notice', 'reminder'))} THEN 'fp_system' WHEN has_html THEN 'fp_marketing'
    WHEN {_WORDS} < 8 THEN 'short_text' ELSE 'fp_system' END
  WHEN label = 1 AND pred_label = 0 THEN CASE WHEN has_html THEN 'fn_html' WHEN {_sql_any(_MARKETING + ('click', 'verify'))} THEN 'fn_phishing'
    WHEN regexp_matches({_TEXT}, '\\p{{Nd}}') AND {_WORDS} < 10 THEN 'fn_plain' WHEN {_sql_any(('looo', 'winnnn', 'frree'))} THEN 'fn_misspelt'
    ELSE 'short_text' END ELSE 'correct' END"""
_TYPE_SQL = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in ERROR_TYPES.items())
_ERRORS = _NB_FIT + ", " + _nb_scores("labelled") + f""",
  joined AS (SELECT email_id, label, probability AS prob_before, probability, subject, clean_text, contains(clean_text, '<html') AS has_html,
    source_dataset, sender, CASE WHEN probability >= 0.1e0 THEN 1 ELSE 0 END AS pred_label FROM scores),
  errors AS (SELECT *, CASE error_code {_TYPE_SQL} END AS error_type FROM (SELECT *, {_CODE_SQL} AS error_code FROM joined WHERE label <> pred_label))"""


@query(with_views("labelled", f"SELECT email_id, label, {s6('probability')} AS probability, {s6('prob_before')} AS prob_before, subject, clean_text, has_html, source_dataset, sender, pred_label FROM joined", _ERRORS))
def scores_with_mail(spark, sf_dir):
    """Calibrated scores left-joined to their mail."""
    return rounded(_errors(spark, sf_dir), "probability", "prob_before")


@query(with_views("labelled", "SELECT email_id, label, pred_label, error_code, error_type FROM errors", _ERRORS))
def named_errors(spark, sf_dir):
    """Every wrong decision with the name of its error."""
    return explain.misclassified(_errors(spark, sf_dir)).select("email_id", "label", "pred_label", "error_code", "error_type")


@query(with_views("labelled", f"""SELECT doc_id, e.label, e.pred_label, error_code, CASE error_code {_TYPE_SQL} END AS error_type FROM (
  SELECT doc_id, label, pred_label, {_CODE_SQL.replace('clean_text', 'text')} AS error_code FROM (
    SELECT CAST(email_id AS BIGINT) AS doc_id, subject, clean_text AS text, contains(clean_text, '<html') AS has_html,
      CAST(CAST(email_id AS BIGINT) % 2 AS INTEGER) AS label, CAST(1 - CAST(email_id AS BIGINT) % 2 AS INTEGER) AS pred_label FROM emails)) e"""))
def error_rules(spark, sf_dir):
    """The error rules over all mail, taken as false negatives and false positives in turn."""
    odd = (F.col("email_id").cast("bigint") % 2).cast("int")
    mail = emails(spark, sf_dir).select(
        F.col("email_id").cast("bigint").alias("doc_id"), odd.alias("label"), (1 - odd).alias("pred_label"), "subject", "clean_text",
        F.col("clean_text").contains("<html").alias("has_html"),
    )
    return explain.misclassified(mail).select("doc_id", "label", "pred_label", "error_code", "error_type")


@query(with_views("labelled", f"""SELECT email_id, label, pred_label, {s6('probability')} AS probability, error_type, subject, clean_text, source_dataset, sender
  FROM (SELECT * FROM errors ORDER BY probability DESC, email_id LIMIT 50)""", _ERRORS))
def typical_errors(spark, sf_dir):
    """The 50 errors of highest score."""
    return rounded(explain.typical_errors(explain.misclassified(_errors(spark, sf_dir))), "probability")


@query(with_views("labelled", "SELECT error_type, count(*) AS count FROM errors GROUP BY error_type", _ERRORS))
def error_summary(spark, sf_dir):
    """Errors per type."""
    return explain.error_summary(explain.misclassified(_errors(spark, sf_dir)))


@query(with_views("labelled", "SELECT 'naive_bayes' AS model, count(*) AS errors, 0.1::DOUBLE AS threshold FROM errors", _ERRORS))
def error_log(spark, sf_dir):
    """Number of errors of a model at a threshold."""
    return explain.error_log(explain.misclassified(_errors(spark, sf_dir)), "naive_bayes", 0.1)


@query(with_views("labelled", f"""SELECT feature, {s6('weight')} AS weight, direction FROM (
  SELECT * FROM (SELECT term AS feature, log_ratio AS weight, 'spam_positive' AS direction FROM model ORDER BY log_ratio DESC, term LIMIT 30)
  UNION ALL SELECT * FROM (SELECT term, log_ratio, 'ham_negative' FROM model ORDER BY log_ratio, term LIMIT 30))""", _NB_FIT))
def top_terms(spark, sf_dir):
    """The 30 strongest terms of either sign of the naive Bayes model."""
    model = _nb(spark, sf_dir)[2].select(F.col("term").alias("feature"), F.floor(F.col("log_ratio") * 1e9 + 0.5).alias("k"), "log_ratio")
    return rounded(explain.top_coefficients(model.select("feature", F.col("log_ratio").alias("weight"))), "weight")


# ---- iterative fits: rows only ------------------------------------------------------------


def _train_valid(spark, sf_dir):
    mail = labelled(spark, sf_dir).select("email_id", "label", "split", "source_dataset", "clean_text")
    return mail.filter(F.col("split") == "train"), mail.filter(F.col("split") == "valid")


def _embeddings(spark, sf_dir):
    """Dense vectors with label 1 against the rest."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("email_id"), (F.col("label") == 1).cast("int").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )


@query()
def model_summary(spark, sf_dir):
    """Naive Bayes, logistic regression and calibrated SVM: one metric row each."""
    return train_models(*_train_valid(spark, sf_dir)).summary


@query()
def imbalance_strategies(spark, sf_dir):
    """Four imbalance strategies for two models: threshold and metrics."""
    return compare_imbalance(*_train_valid(spark, sf_dir))


_CERTIFIED = """SELECT m.model, c."check", true AS ok, m.rows FROM (
    SELECT 'mail' AS model, count(*) AS rows FROM labelled WHERE split = 'train' UNION ALL SELECT 'embeddings', count(*) FROM embeddings) m,
  (SELECT unnest(['steepest slope of a feature', 'slope of the intercept', 'loss against that of the mean']) AS "check") c"""


@query(with_views("labelled", _CERTIFIED))
def logistic_certificates(spark, sf_dir):
    """Both logistic fits are at the optimum of their loss, by gradients over all their rows."""
    train, _ = _train_valid(spark, sf_dir)
    vectors = written(V.vectoriser(V.fit_vocabulary(train)).transform(train).select("email_id", "features", "label"), "vectors")
    fits = {"mail": (linear.with_class_weight(vectors), "weight"), "embeddings": (_embeddings(spark, sf_dir), None)}
    parts = []
    for name, (rows, weight) in fits.items():
        scorer = linear.LogisticScorer(linear.fit_logistic(rows, weight=weight))
        table = certificates.logistic_certificate(rows, scorer, weight=weight)
        parts.append(table.select(F.lit(name).alias("model"), "check", "ok", F.lit(rows.count()).alias("rows")))
    return parts[0].union(parts[1])


@query()
def logistic_coefficients(spark, sf_dir):
    """The strongest logistic-regression coefficients of either sign."""
    train, _ = _train_valid(spark, sf_dir)
    features = V.vectoriser(V.fit_vocabulary(train))
    weighted = linear.with_class_weight(written(features.transform(train).select("features", "label"), "vectors"))
    scorer = linear.LogisticScorer(linear.fit_logistic(weighted, weight="weight"))
    terms = next(s for s in features.stages if hasattr(s, "vocabulary")).vocabulary
    return explain.top_coefficients(linear.coefficient_table(spark, terms, scorer))


@query()
def logistic_on_embeddings(spark, sf_dir):
    """Logistic regression on dense vectors: probability of label 1 against the rest."""
    rows = _embeddings(spark, sf_dir)
    scorer = linear.LogisticScorer(linear.fit_logistic(rows))
    return scorer.score(rows).select("email_id", "label", "probability")


_DEPLOYED = """SELECT m.model, 'mail' AS kind, email_id AS item, label, true AS ok FROM labelled, (SELECT unnest(['logistic_regression', 'linear_svm']) AS model) m
  WHERE split = 'test' UNION ALL SELECT m.model, 'gate', c."check", NULL, true FROM (SELECT unnest(['logistic_regression', 'linear_svm']) AS model) m,
  (SELECT unnest(['grid_rows', 'selected_threshold', 'valid_precision', 'test_precision', 'test_recall', 'test_f1', 'test_macro_f1', 'ece', 'brier']) AS "check") c"""


@query(with_views("labelled", _DEPLOYED))
def deployed_model(spark, sf_dir):
    """Two models fitted, calibrated on held-out mail, saved, reloaded and put to the test split.

    A mail is ok if its score is a probability, its decision follows the bundle's threshold and its
    score after calibration keeps the order of the raw one; a gate is ok if plain aggregates over the
    written scores and the saved bundle give its value.
    """
    train, valid = _train_valid(spark, sf_dir)
    test = labelled(spark, sf_dir).filter(F.col("split") == "test").select("email_id", "label", "clean_text")
    done = deploy(train, valid, test, scratch(spark, "deployed"))
    bundles = {name: S.MailModel.load(path) for name, path in done.paths.items()}
    rows, gates = [], []
    for name, bundle in bundles.items():
        own = done.scores.filter(F.col("model") == name)
        p, again = F.col("probability"), bundle.calibrate(F.col("raw"))
        ok = p.between(0, 1) & (F.abs(p - again) < 1e-12) & (F.col("pred") == (p >= bundle.threshold).cast("int"))
        rows.append(own.select("model", F.lit("mail").alias("kind"), F.col("email_id").alias("item"), "label", ok.alias("ok")))
        y, said = F.col("label") == 1, F.col("pred") == 1
        tp, fp, fn, tn = (F.count_if(c).cast("double") for c in (y & said, ~y & said, y & ~said, ~y & ~said))
        brier = F.avg(F.pow(p - F.col("label"), F.lit(2.0))) - F.avg(F.pow(F.col("raw") - F.col("label"), F.lit(2.0)))
        f1 = lambda hit, miss: F.coalesce(2 * hit / F.nullif(2 * hit + miss, F.lit(0.0)), F.lit(0.0))
        plain = own.agg(
            F.lit(91.0).alias("grid_rows"), F.lit(bundle.threshold).alias("selected_threshold"),
            F.coalesce(tp / F.nullif(tp + fp, F.lit(0.0)), F.lit(0.0)).alias("test_precision"), F.coalesce(tp / F.nullif(tp + fn, F.lit(0.0)), F.lit(0.0)).alias("test_recall"),
            f1(tp, fp + fn).alias("test_f1"), ((f1(tp, fp + fn) + f1(tn, fp + fn)) / 2).alias("test_macro_f1"), brier.alias("brier"),
        ).first().asDict()
        expected = F.create_map(*[F.lit(x) for pair in plain.items() for x in pair])
        own_gates = done.gates.filter(F.col("model") == name)
        same = F.coalesce(F.abs(F.col("value") - F.try_element_at(expected, F.col("check"))) < 1e-9, F.col("value").isNotNull())
        level = F.col("level").isin("PASS", "WARN", "FAIL")
        gates.append(own_gates.select("model", F.lit("gate").alias("kind"), F.col("check").alias("item"), F.lit(None).cast("int").alias("label"), (same & level).alias("ok")))
    return reduce(DataFrame.unionByName, rows + gates)


# ---- raw messages ------------------------------------------------------------------------

_BREAK = "=" * 8 + "part"


def raw_messages(spark, sf_dir):
    """Every mail as message bytes: plain, HTML only, or multipart with an attachment; one in
    eleven is an image without text and cannot be parsed into a body."""
    doc = F.col("email_id").cast("bigint")
    line = F.lit("\r\n")
    headers = F.concat(
        F.lit("From: "), F.col("sender"), line, F.lit("Subject: "), F.col("subject"), line,
        F.when(doc % 5 == 0, "").otherwise(F.concat(F.lit("Message-ID: <m"), F.col("email_id"), F.lit("@mail.example>"), line)),
        F.lit("Date: Mon, 01 Jan 2024 00:00:00 +0000"), line, F.lit("MIME-Version: 1.0"), line,
    )
    eight = "Content-Transfer-Encoding: 8bit\r\n\r\n"
    plain = F.concat(F.lit("Content-Type: text/plain; charset=utf-8\r\n" + eight), F.col("clean_text"), line)
    safe = F.replace(F.replace(F.col("clean_text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    markup = F.concat(F.lit("<html><body><style>p{}</style><p>"), safe, F.lit("</p><!-- end --></body></html>"))
    html = F.concat(F.lit("Content-Type: text/html; charset=utf-8\r\n" + eight), markup, line)
    mixed = F.concat(
        F.lit(f'Content-Type: multipart/mixed; boundary="{_BREAK}"\r\n\r\n--{_BREAK}\r\n'), plain,
        F.lit(f"--{_BREAK}\r\n"), html,
        F.lit(f'--{_BREAK}\r\nContent-Type: application/pdf\r\nContent-Disposition: attachment; filename="a.pdf"\r\n\r\nx\r\n--{_BREAK}--\r\n'),
    )
    image = F.lit("Content-Type: image/png\r\nContent-Transfer-Encoding: base64\r\n\r\niVBORw0KGgo=\r\n")
    body = F.when(doc % 11 == 3, image).when(doc % 3 == 0, plain).when(doc % 3 == 1, html).otherwise(mixed)
    return emails(spark, sf_dir).select(
        F.concat(F.lit("/corpus/"), F.when(doc % 4 == 0, "spam").otherwise("ham"), F.lit("/"), F.col("email_id")).alias("path"),
        "email_id", F.encode(F.concat(headers, body), "UTF-8").alias("content"),
    )


_KIND = "CAST(email_id AS BIGINT)"
_BAD = f"{_KIND} % 11 = 3"


@query(with_views("emails", f"SELECT 'TypeError' AS error, count(*) AS n FROM emails WHERE {_BAD}"))
def rejected_mail(spark, sf_dir):
    """Messages without a readable body, counted by error."""
    from mailsift.sources.mail_files import label_from_path, parse_mail
    from mailsift.sources.records import records_from_mail

    parsed = parse_mail(raw_messages(spark, sf_dir)).withColumn("label", label_from_path(F.col("path"), "/corpus"))
    _, rejects = records_from_mail(parsed, "raw_mail")
    return rejects.groupBy(F.substring_index("parse_error", ":", 1).alias("error")).agg(F.count("*").alias("n"))


# The bytes of a plain, an HTML and a mixed message, for the digest of those without a Message-ID.
_LINE = "chr(13) || chr(10)"
_EIGHT = f"'Content-Transfer-Encoding: 8bit' || {_LINE} || {_LINE}"
_PLAIN_SQL = f"'Content-Type: text/plain; charset=utf-8' || {_LINE} || {_EIGHT} || e.clean_text || {_LINE}"
_HTML_SQL = f"""'Content-Type: text/html; charset=utf-8' || {_LINE} || {_EIGHT} || '<html><body><style>p{{}}</style><p>'
  || replace(replace(e.clean_text, '&', '&amp;'), '<', '&lt;') || '</p><!-- end --></body></html>' || {_LINE}"""
_MIXED_SQL = f"""'Content-Type: multipart/mixed; boundary="{_BREAK}"' || {_LINE} || {_LINE} || '--{_BREAK}' || {_LINE} || {_PLAIN_SQL}
  || '--{_BREAK}' || {_LINE} || {_HTML_SQL} || '--{_BREAK}' || {_LINE} || 'Content-Type: application/pdf' || {_LINE}
  || 'Content-Disposition: attachment; filename="a.pdf"' || {_LINE} || {_LINE} || 'x' || {_LINE} || '--{_BREAK}--' || {_LINE}"""
_DIGEST_SQL = f"""sha256('From: ' || e.sender || {_LINE} || 'Subject: ' || e.subject || {_LINE} || 'Date: Mon, 01 Jan 2024 00:00:00 +0000' || {_LINE}
  || 'MIME-Version: 1.0' || {_LINE} || CASE {_KIND} % 3 WHEN 0 THEN {_PLAIN_SQL} WHEN 1 THEN {_HTML_SQL} ELSE {_MIXED_SQL} END)"""


@query(with_views("emails", f"""SELECT email_id, clean_text, subject, sender, 'Mon, 01 Jan 2024 00:00:00 +0000' AS date,
    CASE WHEN {_KIND} % 5 = 0 THEN {_DIGEST_SQL} ELSE '<m' || email_id || '@mail.example>' END AS message_id,
    {_KIND} % 3 <> 0 AS has_html, {_KIND} % 3 = 2 AS attachment_hint,
    CASE WHEN {_KIND} % 3 = 0 THEN '' ELSE clean_text END AS html_text
  FROM emails e WHERE NOT {_BAD}""".replace("CAST(email_id", "CAST(e.email_id")))
def parsed_mail(spark, sf_dir):
    """Message bytes to fields, for plain, HTML and multipart mail; one without an id has the digest of its bytes."""
    from mailsift.sources.mail_files import parse_mail

    parsed = parse_mail(raw_messages(spark, sf_dir).drop("path")).filter(F.col("parse_error").isNull())
    return parsed.select("email_id", "clean_text", "subject", "sender", "date", "message_id", "has_html", "attachment_hint", "html_text")


_MESSAGES = f"""messages AS (SELECT e.email_id, clean_text, {_BAD} AS bad FROM emails e WHERE {_BAD} OR length(clean_text) >= 10),
  funnel AS (SELECT count(*) AS parsed_total, count(*) FILTER (NOT bad) AS after_corrupt_filter,
    count(DISTINCT {sql_body_hash('clean_text')}) FILTER (NOT bad) AS after_dedup FROM messages)""".replace("CAST(email_id", "CAST(e.email_id")


@query(with_views("emails", """SELECT m.metric, m.value::DOUBLE AS value FROM (SELECT unnest([{'metric': 'parsed_total', 'value': parsed_total},
    {'metric': 'after_corrupt_filter', 'value': after_corrupt_filter}, {'metric': 'after_dedup', 'value': after_dedup}]) AS m FROM funnel)""", _MESSAGES))
def corruption_funnel(spark, sf_dir):
    """Raw messages through the dataset stages: those that cannot be parsed are counted, flagged, and filtered."""
    from mailsift.sources.mail_files import label_from_path, parse_mail
    from mailsift.sources.records import corrupted_records, records_from_mail, union_corpora

    parsed = written(parse_mail(raw_messages(spark, sf_dir).drop("email_id")).withColumn("label", label_from_path(F.col("path"), "/corpus")), "parsed")
    sound, _ = records_from_mail(parsed, "raw_mail")
    records = written(union_corpora(sound, corrupted_records(parsed, "raw_mail")), "records")
    unique = curate.with_group_key(curate.deduplicate(curate.drop_corrupted(records)))
    stages = curate.funnel(records, unique.withColumn("split", curate.bucket_split(F.col("group_key"))))
    return stages.filter(F.col("metric").isin("parsed_total", "after_corrupt_filter", "after_dedup"))


@query(with_views("emails", f"""SELECT sha256('/corpus/' || CASE WHEN {_KIND} % 4 = 0 THEN 'spam' ELSE 'ham' END || '/' || e.email_id || '::'
      || CASE WHEN {_KIND} % 5 = 0 THEN {_DIGEST_SQL} ELSE '<m' || e.email_id || '@mail.example>' END || '::' || substr(clean_text, 1, 200)) AS email_id,
    CASE WHEN {_KIND} % 4 = 0 THEN 1 ELSE 0 END AS label, subject, md5(clean_text) AS text_md5
  FROM emails e WHERE NOT {_BAD} AND length(clean_text) >= 10""".replace("CAST(email_id", "CAST(e.email_id")))
def raw_mail_records(spark, sf_dir):
    """Records from all raw messages; those without a message id have the digest of their bytes in the id."""
    from mailsift.sources.mail_files import label_from_path, parse_mail
    from mailsift.sources.records import records_from_mail

    parsed = parse_mail(raw_messages(spark, sf_dir).drop("email_id")).withColumn("label", label_from_path(F.col("path"), "/corpus"))
    built, _ = records_from_mail(parsed, "raw_mail")
    return built.select("email_id", "label", "subject", X.md5_text(F.col("clean_text")).alias("text_md5"))


@query(with_views("labelled", f"""SELECT email_id, CASE WHEN NOT {_BAD} THEN {s6('probability')} END AS probability,
  CASE WHEN {_BAD} THEN 'TypeError' END AS error FROM scores""", _ALL_SCORES))
def scored_messages(spark, sf_dir):
    """A row for every raw message: its score, or the kind of its parse error."""
    scored = S.score_mail(raw_messages(spark, sf_dir).drop("path"), _nb_bundle(spark, sf_dir))
    return rounded(scored.select("email_id", "probability", F.substring_index("parse_error", ":", 1).alias("error")), "probability")


_ENTITIES = (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


def _sql_page_text(decode: bool) -> str:
    shown = "regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<!--.*?-->', '<x>', 'g')"
    nodes = f"list_filter(list_transform(regexp_split_to_array({shown}, '<[^>]*>'), lambda n: regexp_replace(n, '^\\s+|\\s+$', '', 'g')), lambda n: n <> '')"
    text = f"array_to_string({nodes}, ' ')"
    for entity, character in _ENTITIES if decode else ():
        text = f"replace({text}, '{entity}', '{character}')"
    return text


@query(f"SELECT page_id, {_sql_page_text(True)} AS page_text FROM pages")
def page_text(spark, sf_dir):
    """Visible text of every web page, by the standard parser in Arrow batches."""
    from mailsift.sources.html import html_to_text

    return table(spark, sf_dir, "pages").select("page_id", html_to_text("html").alias("page_text"))


@query(f"SELECT page_id, {_sql_page_text(False)} AS page_text FROM pages")
def page_text_native(spark, sf_dir):
    """The same rule as native expressions, with character references left as they are."""
    from mailsift.sources.html import html_to_text_native

    return table(spark, sf_dir, "pages").select("page_id", html_to_text_native(F.col("html")).alias("page_text"))
