"""TF-IDF, scaling and block queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from mailsift.config import CHAR_NGRAMS, MAX_FEATURES, SVD_COMPONENTS
from mailsift.functions.features import FEATURE_NAMES, structured_features
from mailsift.operators import certificates, vectors as V
from mailsift.session import written
from mailsift.plans.curation_queries import scratch
from mailsift.plans.inputs import emails, labelled, with_views
from mailsift.plans.registry import query, r6, rounded, s6
from mailsift.plans.text_queries import sql_features

# ---- terms and weights in SQL ------------------------------------------------------------


def sql_word_counts(source: str, out: str) -> str:
    """CTE (email_id, term, tf) of word 1- and 2-grams."""
    return f"""{out} AS (SELECT email_id, term, count(*) AS tf FROM (
      SELECT email_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
      FROM (SELECT email_id, regexp_extract_all(lower(clean_text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM {source})) GROUP BY ALL)"""


def sql_char_counts(source: str, out: str) -> str:
    """CTE (email_id, term, tf) of padded character 3- to 5-grams."""
    low, high = CHAR_NGRAMS
    return f"""{out} AS (SELECT email_id, term, sum(c)::BIGINT AS tf FROM (
      SELECT email_id, c, unnest(list_transform(range(1, greatest(1, length(w) + 3 - n) + 1), lambda i: substr(' ' || w || ' ', i, n))) AS term
      FROM (SELECT email_id, w, count(*) AS c FROM (SELECT email_id, unnest(string_split(lower(clean_text), ' ')) AS w FROM {source}) WHERE w <> '' GROUP BY ALL),
        range({low}, {high + 1}) g(n) WHERE n = {low} OR length(w) + 2 >= n) GROUP BY ALL)"""


def sql_vocabulary(counts: str, documents: str, out: str, limit: int = MAX_FEATURES) -> str:
    return f"""{out} AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, cf, df,
      ln((1e0 + (SELECT count(*) FROM {documents})) / (1e0 + df)) + 1e0 AS idf FROM (
        SELECT term, sum(tf)::BIGINT AS cf, count(*) AS df FROM {counts} GROUP BY term HAVING count(*) >= 2 ORDER BY cf DESC, term LIMIT {limit}))"""


def sql_tfidf(counts: str, vocabulary: str, out: str) -> str:
    return f"""{out} AS (SELECT email_id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY email_id)) AS weight FROM (
      SELECT c.email_id, c.term, v.idx, c.tf * v.idf AS w FROM {counts} c JOIN {vocabulary} v ON c.term = v.term))"""


_WORD_ALL = ", ".join([sql_word_counts("emails", "counts"), sql_vocabulary("counts", "emails", "vocabulary")])
_CHAR_ALL = ", ".join([sql_char_counts("emails", "counts"), sql_vocabulary("counts", "emails", "vocabulary")])
_PER_DOC = f"""SELECT email_id, count(*) AS terms, {s6('sum(weight)')} AS total, {s6('sum(weight * idx) / sum(weight)')} AS mean_idx FROM weights GROUP BY email_id"""


def _fitted(spark, sf_dir, kind):
    """All mail, and the vocabulary of all of it."""
    mail = emails(spark, sf_dir).select("email_id", "clean_text")
    return mail, V.fit_vocabulary(mail, kind)


def _per_document(weights):
    """Every weight of every document folded into four numbers."""
    return rounded(
        weights.groupBy("email_id").agg(
            F.count("*").alias("terms"), F.sum("weight").alias("total"),
            (F.sum(F.col("weight") * F.col("idx")) / F.sum("weight")).alias("mean_idx"),
        ),
        "total", "mean_idx",
    )


@query(with_views("emails", f"SELECT term, idx, cf, df, {s6('idf')} AS idf FROM vocabulary", _WORD_ALL))
def word_vocabulary(spark, sf_dir):
    """Word 1- and 2-grams: corpus count, document count, idf and index."""
    return rounded(_fitted(spark, sf_dir, "word")[1], "idf")


@query(with_views("emails", f"SELECT email_id, term, idx, {s6('weight')} AS weight FROM weights", _WORD_ALL + ", " + sql_tfidf("counts", "vocabulary", "weights")))
def word_tfidf(spark, sf_dir):
    """Word TF-IDF weights of every document in long form."""
    return rounded(V.tfidf(*_fitted(spark, sf_dir, "word")), "weight")


@query(with_views("emails", f"SELECT term, idx, cf, df, {s6('idf')} AS idf FROM vocabulary", _CHAR_ALL))
def char_vocabulary(spark, sf_dir):
    """Character 3- to 5-grams inside padded words."""
    return rounded(_fitted(spark, sf_dir, "char")[1], "idf")


@query(with_views("emails", _PER_DOC, _CHAR_ALL + ", " + sql_tfidf("counts", "vocabulary", "weights")))
def char_tfidf(spark, sf_dir):
    """Character TF-IDF of every document, all weights folded per document."""
    return _per_document(V.tfidf(*_fitted(spark, sf_dir, "char"), kind="char"))


@query(with_views("emails", _PER_DOC, _WORD_ALL + ", " + sql_tfidf("counts", "vocabulary", "weights")))
def word_vectors(spark, sf_dir):
    """The same word weights as sparse vectors, opened and folded per document."""
    mail, vocabulary = _fitted(spark, sf_dir, "word")
    return _per_document(V.vector_entries(V.vectoriser(vocabulary).transform(mail), "features"))


_TRAIN_FIT = ", ".join([
    "train AS (SELECT * FROM labelled WHERE split = 'train')", sql_word_counts("labelled", "counts"),
    "train_counts AS (SELECT c.* FROM counts c JOIN train t ON c.email_id = t.email_id)",
    sql_vocabulary("train_counts", "train", "vocabulary"), sql_tfidf("counts", "vocabulary", "weights"),
])


@query(with_views("labelled", f"""SELECT l.split, count(*) AS weights, count(DISTINCT w.email_id) AS documents, {s6('sum(w.weight)')} AS total
  FROM weights w JOIN labelled l ON w.email_id = l.email_id GROUP BY l.split""", _TRAIN_FIT))
def train_fitted_tfidf(spark, sf_dir):
    """Vocabulary and idf from the train split, weights of every split."""
    mail = labelled(spark, sf_dir).select("email_id", "split", "clean_text")
    weights = V.tfidf(mail, V.fit_vocabulary(mail.filter(F.col("split") == "train")), keep=("split",))
    per_split = weights.groupBy("split").agg(
        F.count("*").alias("weights"), F.count_distinct("email_id").alias("documents"), F.sum("weight").alias("total")
    )
    return rounded(per_split, "total")


# ---- scaling and blocks ------------------------------------------------------------------

_TRAIN = "train AS (SELECT * FROM labelled WHERE split = 'train')"
_FEATURES_CTE = _TRAIN + ", f AS (" + sql_features("email_id", "clean_text", "emails") + "), tf AS (" + sql_features("email_id", "clean_text", "train") + ")"
# Ratios come back rounded from the shared feature SQL, so both sides scale rounded ratios.
_RATIOS = ("upper_ratio", "digit_ratio", "punctuation_density")


def _sql_scale(column: str) -> str:
    return f"(SELECT CASE WHEN stddev_pop({column}) = 0 THEN 1e0 ELSE stddev_pop({column}) END FROM tf)"


def _sql_scaled(with_mean: bool) -> str:
    columns = ", ".join(
        s6(f"({c}{f' - (SELECT avg({c}) FROM tf)' if with_mean else ''}) / {_sql_scale(c)}") + f" AS {c}" for c in FEATURE_NAMES
    )
    return f"SELECT email_id, {columns} FROM f"


def _features(mail):
    return rounded(structured_features(mail), *_RATIOS)


def _train(spark, sf_dir):
    return labelled(spark, sf_dir).filter(F.col("split") == "train").select("email_id", "clean_text")


@query(with_views("emails labelled", _sql_scaled(True), _FEATURES_CTE))
def standardised_features(spark, sf_dir):
    """Structured features of all mail by the mean and population deviation of the train split."""
    scaler = V.fit_scaler(_features(_train(spark, sf_dir)))
    return rounded(V.apply_scaler(_features(emails(spark, sf_dir)), scaler), *FEATURE_NAMES)


@query(with_views("emails labelled", _sql_scaled(False), _FEATURES_CTE))
def scaled_features(spark, sf_dir):
    """Structured features of all mail divided by the train split's deviation: zeros stay zero."""
    scaler = V.fit_scaler(_features(_train(spark, sf_dir)))
    return rounded(V.apply_scaler(_features(emails(spark, sf_dir)), scaler, with_mean=False), *FEATURE_NAMES)


# Vocabularies and scales of the train split, weights of all mail.
_HYBRID_SQL = f"""SELECT e.email_id, CAST(coalesce(w.n, 0) + coalesce(c.n, 0) + s.n AS BIGINT) AS values, {s6('coalesce(w.s, 0) + coalesce(c.s, 0) + s.s')} AS squared
  FROM emails e LEFT JOIN (SELECT email_id, count(*) AS n, sum(weight * weight) AS s FROM ww GROUP BY 1) w ON e.email_id = w.email_id
  LEFT JOIN (SELECT email_id, count(*) AS n, sum(weight * weight) AS s FROM cw GROUP BY 1) c ON e.email_id = c.email_id
  JOIN (SELECT email_id, {' + '.join(f'(CASE WHEN {c} <> 0 THEN 1 ELSE 0 END)' for c in FEATURE_NAMES)} AS n,
    {' + '.join(f'{c} * {c}' for c in FEATURE_NAMES)} AS s FROM scaled) s ON e.email_id = s.email_id"""
_HYBRID_CTES = ", ".join([
    _FEATURES_CTE, sql_word_counts("train", "wt"), sql_vocabulary("wt", "train", "wv"), sql_word_counts("emails", "wc"), sql_tfidf("wc", "wv", "ww"),
    sql_char_counts("train", "ct"), sql_vocabulary("ct", "train", "cv"), sql_char_counts("emails", "cc"), sql_tfidf("cc", "cv", "cw"),
    f"scaled AS (SELECT email_id, {', '.join(f'{c} / {_sql_scale(c)} AS {c}' for c in FEATURE_NAMES)} FROM f)",
])


def _blocks(spark, sf_dir):
    """All mail with word vector, character vector and scaled features, every block fitted on the train split."""
    train, mail = written(_train(spark, sf_dir), "train"), emails(spark, sf_dir).select("email_id", "clean_text")
    scaler = V.fit_scaler(_features(train))
    rows = rounded(structured_features(mail, keep=("email_id", "clean_text")), *_RATIOS)
    rows = V.apply_scaler(rows, scaler, with_mean=False)
    for kind in ("word", "char"):
        rows = V.with_vectors(rows, V.fit_vocabulary(train, kind), kind, out=kind)
    return rows


@query(with_views("emails labelled", _HYBRID_SQL, _HYBRID_CTES))
def hybrid_block(spark, sf_dir):
    """Word, character and structured blocks side by side: entries and squared length."""
    entries = V.vector_entries(V.hybrid(_blocks(spark, sf_dir)), "hybrid").filter(F.col("weight") != 0)
    return entries.groupBy("email_id").agg(
        F.count("*").alias("values"), r6(F.sum(F.col("weight") * F.col("weight"))).alias("squared")
    )


@query()
def svd_block(spark, sf_dir):
    """Truncated SVD of the word block beside the standardised features.

    The factorisation is iterative, so SQL has no twin; the test compares singular values and
    projections with a dense factorisation.
    """
    mail, train = emails(spark, sf_dir), _train(spark, sf_dir)
    model, right, _ = _train_svd(train)
    rows = V.apply_svd(model.transform(mail).select("email_id", "features"), right).select("email_id", vector_to_array("svd").alias("svd"))
    scaler = V.fit_scaler(structured_features(train))
    return V.apply_scaler(structured_features(mail), scaler).join(rows, "email_id")


@query(with_views("labelled", f"""SELECT c."check", true AS ok, least({SVD_COMPONENTS}, (SELECT count(*) FROM labelled WHERE split = 'train')) AS components
  FROM (SELECT unnest(['tilt of the vectors', 'residual of the Gram matrix', 'share of the squared length']) AS "check") c"""))
def svd_certificate(spark, sf_dir):
    """The singular vectors of the training mail are orthonormal and invariant under its Gram matrix, by sums over all rows."""
    train = written(_train(spark, sf_dir), "train")
    model, right, values = _train_svd(train)
    vectors = written(model.transform(train).select("email_id", "features"), "vectors")
    checks = certificates.svd_certificate(vectors, values, right)
    return checks.select("check", "ok", F.lit(right.shape[1]).cast("long").alias("components"))


def _train_svd(train):
    """The word vectoriser, right singular vectors and singular values of the training mail."""
    model = V.vectoriser(V.fit_vocabulary(train, max_features=50_000))
    # More values than rows would be rounding noise.
    values, right = V.fit_svd(model.transform(train).select("email_id", "features"), k=min(SVD_COMPONENTS, train.count()))
    return model, right, values


_DIMS_FIT = ", ".join([
    _TRAIN_FIT, sql_char_counts("train", "char_counts"), sql_vocabulary("char_counts", "train", "char_vocabulary"),
    "dims AS (SELECT (SELECT count(*) FROM vocabulary) AS w, (SELECT count(*) FROM char_vocabulary) AS c, (SELECT count(*) FROM train) AS n)",
])


@query(with_views("labelled", f"""SELECT m.metric, m.value FROM (SELECT unnest([
    {{'metric': 'word_dim', 'value': w}}, {{'metric': 'char_dim', 'value': c}}, {{'metric': 'structured_dim', 'value': {len(FEATURE_NAMES)}::BIGINT}},
    {{'metric': 'hybrid_dim', 'value': w + c + {len(FEATURE_NAMES)}}}, {{'metric': 'svd_dim', 'value': least({SVD_COMPONENTS}, w, n) + {len(FEATURE_NAMES)}}},
    {{'metric': 'train_size', 'value': n}},
    {{'metric': 'valid_size', 'value': (SELECT count(*) FROM labelled WHERE split = 'valid')}},
    {{'metric': 'test_size', 'value': (SELECT count(*) FROM labelled WHERE split = 'test')}}]) AS m FROM dims)""", _DIMS_FIT))
def block_sizes(spark, sf_dir):
    """All five feature dimensions, fitted on the train split, and the split sizes; the SVD block holds the structured columns too."""
    mail = labelled(spark, sf_dir).select("email_id", "split", "clean_text")
    train = mail.filter(F.col("split") == "train")
    word, char = (V.fit_vocabulary(train, kind).count() for kind in ("word", "char"))
    _, right, _ = _train_svd(train)
    dims = {"word_dim": word, "char_dim": char, "structured_dim": len(FEATURE_NAMES),
            "hybrid_dim": word + char + len(FEATURE_NAMES), "svd_dim": right.shape[1] + len(FEATURE_NAMES)}
    return V.block_sizes({name: F.lit(value) for name, value in dims.items()}, mail)


@query(with_views("labelled", """SELECT email_id, label, source_dataset, ['word', 'char', 'structured', 'hybrid', 'svd'][rn] AS feature_block FROM (
  SELECT *, row_number() OVER (ORDER BY email_id) AS rn FROM labelled WHERE split = 'train') WHERE rn <= 5"""))
def block_sample(spark, sf_dir):
    """The first five training mails beside the names of the five blocks."""
    return V.sample_check(labelled(spark, sf_dir).filter(F.col("split") == "train"))


@query(with_views("labelled", f"SELECT split, count(*) AS weights, {s6('sum(weight)')} AS total FROM weights w JOIN labelled l ON w.email_id = l.email_id GROUP BY split", _TRAIN_FIT))
def vector_round_trip(spark, sf_dir):
    """Sparse vectors written per split, and one total per split read back."""
    mail = labelled(spark, sf_dir).select("email_id", "split", "clean_text")
    train = mail.filter(F.col("split") == "train")
    path = scratch(spark, "vectors")
    vectors = V.vectoriser(V.fit_vocabulary(train)).transform(mail)
    vectors.select("email_id", "split", "features").write.partitionBy("split").parquet(path)
    back = spark.read.parquet(path)
    entries = V.vector_entries(back, "features", keep=("split",))
    return entries.groupBy("split").agg(F.count("*").alias("weights"), r6(F.sum("weight")).alias("total"))
