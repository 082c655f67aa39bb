"""Vocabularies and vector blocks against plain versions, the SVD block against a dense factorisation."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import Vectors

from mailsift.operators import factor, vectors as V


def test_svd_equals_a_dense_factorisation(spark):
    rng = np.random.default_rng(3)
    dense = rng.random((30, 6)) * (rng.random((30, 6)) < 0.6)
    rows = spark.createDataFrame(
        [(str(i), Vectors.sparse(6, {j: float(x) for j, x in enumerate(row) if x})) for i, row in enumerate(dense)],
        ["email_id", "features"],
    )
    values, right = V.fit_svd(rows, k=3)
    assert np.allclose(values, np.linalg.svd(dense, compute_uv=False)[:3], atol=1e-8)
    for row in V.apply_svd(rows, right).collect():
        assert np.allclose(row.svd.toArray(), dense[int(row.email_id)] @ right, atol=1e-12)


def test_svd_passes_do_not_grow_with_the_components(spark):
    rng = np.random.default_rng(4)
    dense = rng.random((400, 300)) * (rng.random((400, 300)) < 0.1)
    rows = spark.createDataFrame([(Vectors.sparse(300, {j: float(x) for j, x in enumerate(row) if x}),) for row in dense], ["features"])
    spark.sparkContext.setJobGroup("svd", "svd")
    values, right = V.fit_svd(rows, k=60)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("svd"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 60
    assert np.allclose(values, np.linalg.svd(dense, compute_uv=False)[:60], atol=1e-8)
    assert np.allclose(dense.T @ (dense @ right), right * values**2, atol=1e-6)


def test_repeated_singular_values_are_all_found():
    matrix = np.diag(np.r_[np.full(100, 2.0), np.ones(400)])
    squares, right = factor.leading(lambda x: matrix @ (matrix @ x), 500, 150)
    assert np.allclose(squares, np.r_[np.full(100, 4.0), np.ones(50)])
    assert np.allclose(right.T @ right, np.eye(150))


# ---- vocabulary --------------------------------------------------------------------------


def _texts(n=120):
    rng = np.random.default_rng(8)
    return [" ".join("".join(rng.choice(list("abé_1"), rng.integers(1, 4))) for _ in range(rng.integers(0, 25))) for _ in range(n)] + ["", "x", None]


def _grams(text, kind):
    text = (text or "").lower()
    if kind == "word":
        words = re.findall(r"\w{2,}", text)
        return words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    out = []
    for chunk in text.split():
        padded = f" {chunk} "
        out += [padded[i : i + n] for n in (3, 4, 5) if n == 3 or len(padded) >= n for i in range(max(1, len(padded) - n + 1))]
    return out


@pytest.mark.parametrize("kind", ["word", "char"])
@pytest.mark.parametrize("most", [1, 7, 40, 10_000])
def test_vocabulary_keeps_the_most_frequent_and_cuts_ties_by_name(spark, kind, most):
    texts = _texts()
    cf, df = Counter(), Counter()
    for text in texts:
        cf.update(_grams(text, kind))
        df.update(set(_grams(text, kind)))
    want = sorted((t for t in cf if df[t] >= 2), key=lambda t: (-cf[t], t.encode()))[:most]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "email_id string, clean_text string").repartition(3)
    got = V.fit_vocabulary(frame, kind, max_features=most).collect()
    assert sorted((r.term, r.cf, r.df) for r in got) == sorted((t, cf[t], df[t]) for t in want)
    assert [r.term for r in sorted(got, key=lambda r: r.idx)] == sorted(want, key=str.encode)
    assert all(abs(r.idf - (np.log((1 + len(texts)) / (1 + r.df)) + 1)) < 1e-12 for r in got)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_move_terms_once_and_no_text(spark):
    frame = spark.createDataFrame([("1", "ab cd")], "email_id string, clean_text string")
    words, chars = (_plan(V.term_statistics(frame, kind)) for kind in ("word", "char"))
    assert words.count("Exchange ") == 1 and "hashpartitioning(term" in words
    assert chars.count("hashpartitioning(term") == 1 and "TakeOrdered" not in words + chars
    weights = _plan(V.tfidf(frame, V.fit_vocabulary(frame, min_df=1)))
    assert "hashpartitioning" not in weights and "Python" not in weights and "Arrow" not in weights


def test_entries_of_sparse_and_dense_vectors(spark):
    rows = [("s", Vectors.sparse(5, {1: 2.0, 4: 3.0})), ("d", Vectors.dense([7.0, 0.0])), ("e", Vectors.sparse(3, {})), ("z", Vectors.dense([]))]
    entries = V.vector_entries(spark.createDataFrame(rows, ["email_id", "v"]), "v").collect()
    assert sorted(map(tuple, entries)) == [("d", 0, 7.0), ("d", 1, 0.0), ("s", 1, 2.0), ("s", 4, 3.0)]


def test_projection_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(V, "STRETCH", 4)
    vectors = pd.DataFrame({"indices": [np.array([0, 2]), None, np.array([], int), np.array([1])], "values": [[1.0, 2.0], [3.0, 4.0, 5.0], [], [6.0]]})
    seen = [(rows.tolist(), starts.tolist(), positions.tolist()) for rows, starts, positions, _ in V._stretches(vectors)]
    assert [r for rows, _, _ in seen for r in rows] == [0, 1, 3]
    assert [p for _, _, positions in seen for p in positions] == [0, 2, 0, 1, 2, 1]


@pytest.mark.parametrize("kind", ["word", "char"])
def test_statistics_of_many_parts_rows_and_alphabets(spark, kind, monkeypatch):
    """Every path of the counting: parts of few tokens, stretches inside a row, more letters than five of fit a number."""
    monkeypatch.setattr(V, "COUNTED", 7)
    monkeypatch.setattr(V, "OPENED", 5)
    monkeypatch.setattr(V, "SENT", 3)
    wide = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 6000))
    texts = _texts(60) + [wide + " ab " + wide[100:900], "\x00a b\x00 \U0001F600\U0001F601x é" * 3, "  "]
    cf, df = Counter(), Counter()
    count = V._count_words((1, 2)) if kind == "word" else V._count_chars((3, 5))
    cut = [re.findall(r"\w{2,}", (t or "").lower()) if kind == "word" else (t or "").lower().split() for t in texts]
    batches = [pa.RecordBatch.from_arrays([pa.array(cut[i : i + 20], pa.list_(pa.string()))], names=["_t"]) for i in range(0, len(cut), 20)]
    for part in count(iter(batches)):
        assert part.num_rows <= 3
        for r in part.to_pylist():
            cf[r["term"]] += r["cf"]
            df[r["term"]] += r["df"]
    want_cf, want_df = Counter(), Counter()
    for text in texts:
        want_cf.update(_grams(text, kind))
        want_df.update(set(_grams(text, kind)))
    assert cf == want_cf and df == want_df


def test_a_statistics_row_is_made_per_term_of_many_rows_not_per_document():
    tokens = pa.array([["ab", "cd"]] * 1000, pa.list_(pa.string()))
    for count, terms in ((V._count_words((1, 2)), 3), (V._count_chars((3, 5)), 2 * (2 + 1))):
        assert sum(part.num_rows for part in count(iter([pa.RecordBatch.from_arrays([tokens], names=["_t"])]))) == terms


def test_char_vectors_of_rows_cut_together_are_those_of_the_saved_transformer(spark, monkeypatch):
    texts = _texts(80) + ["é" * 40, "  ", "zzz"]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "email_id string, clean_text string").repartition(2)
    vocabulary = V.fit_vocabulary(frame, "char", max_features=90)
    want = {r.email_id: r.features for r in V.vectoriser(vocabulary, "char").transform(frame).collect()}
    made = V.with_vectors(frame, vocabulary, "char")
    got = {r.email_id: r.features for r in made.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k].toArray(), want[k].toArray(), atol=1e-14) for k in want)
    assert "regexp_extract_all" not in _plan(made)
    terms, idf = pa.array([r.term for r in sorted(vocabulary.collect(), key=lambda r: r.idx)]), np.ones(90)
    lists = pa.array([(t or "").lower().split() for t in texts], pa.list_(pa.string()))
    whole = [np.concatenate(c) for c in zip(*V._char_weights(lists, terms, idf))]
    monkeypatch.setattr(V, "OPENED", 3)
    cut = [np.concatenate(c) for c in zip(*V._char_weights(lists, terms, idf))]
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut)) and len(cut[0]) == len(texts)
    empty = V.with_vectors(frame, vocabulary.limit(0), "char").collect()
    assert len(empty) == len(texts) and all(r.features.size == 0 for r in empty)


def test_a_vocabulary_is_sent_in_one_call(spark, monkeypatch):
    """Tens of thousands of terms, one call to the JVM each, took longer than the vectors."""
    monkeypatch.setattr(CountVectorizerModel, "_new_java_array", None)
    mail = spark.createDataFrame([("1", "böse mail böse"), ("2", "gute mail"), ("3", "")], "email_id string, clean_text string")
    features = V.vectoriser(V.fit_vocabulary(mail, min_df=1))
    terms = next(s for s in features.stages if hasattr(s, "vocabulary")).vocabulary
    assert terms == sorted(["böse", "mail", "gute", "böse mail", "mail böse", "gute mail"])
    found = {r.email_id: dict(zip(r.features.indices, r.features.values)) for r in features.transform(mail).collect()}
    assert sorted(terms[i] for i in found["1"]) == ["böse", "böse mail", "mail", "mail böse"] and not found["3"]
