"""Word and character TF-IDF, scaling, hybrid and SVD blocks.

Two forms of the same numbers. The vector form counts inside a row and never shuffles; the long form
(key, term, weight) opens those vectors. Only the statistics of the terms are shuffled, once, by term.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.config import CHAR_NGRAMS, MAX_FEATURES, MIN_DF, SVD_COMPONENTS, WORD_NGRAMS
from mailsift.functions.features import FEATURE_NAMES
from mailsift.functions.patterns import SPACE, VECTOR_TOKEN
from mailsift.functions.text import no_null
from mailsift.operators import factor
from mailsift.operators.order import numbered
from mailsift.session import written

GRAM = r"(?=([^\n]{{{n}}}))[^\n]"  # an n-gram at every character that has n of its line before it
LEVELS = 16  # histogram levels for each doubling of a count
STRETCH = 20_000  # vector entries multiplied at once in a projection
COUNTED, ROWS = 1 << 20, 1 << 18  # tokens and rows whose terms are counted together
OPENED = 1 << 20  # grams of rows that are looked at together
SENT = 100_000  # counts in an Arrow batch

# ---- terms -------------------------------------------------------------------------------


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(no_null(text)), F.lit(VECTOR_TOKEN), F.lit(0))


def ngrams(tokens: Column, sizes: tuple[int, int] = WORD_NGRAMS) -> Column:
    """All n-grams of an array of tokens for n from sizes[0] to sizes[1], joined by a space."""
    grams, found = tokens, []
    for n in range(1, sizes[1] + 1):
        if n > 1:
            length = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
            grams = F.zip_with(
                F.slice(grams, F.lit(1), length), F.slice(tokens, F.lit(n), length), lambda a, b: F.concat(a, F.lit(" "), b)
            )
        if n >= sizes[0]:
            found.append(grams)
    return found[0] if len(found) == 1 else F.concat(*found)


def word_chunks(text: Column) -> Column:
    """Lower-case chunks between white space, the units of character n-grams."""
    return F.filter(F.split(F.lower(no_null(text)), SPACE + "+"), lambda w: w != "")


def padded(chunks: Column) -> Column:
    """Chunks with a space on either side, a line each; white space cut the chunks, so none holds a line break."""
    return F.concat(F.lit(" "), F.array_join(chunks, " \n "), F.lit(" "))


def line_grams(lines: Column, sizes: tuple[int, int] = CHAR_NGRAMS) -> Column:
    """All character n-grams inside the lines: a look-ahead takes the gram and the match moves on by one character.

    A padded chunk has three characters or more, so a chunk shorter than n gives none of length n.
    """
    return F.concat(*[F.regexp_extract_all(lines, F.lit(GRAM.format(n=n)), F.lit(1)) for n in range(sizes[0], sizes[1] + 1)])


def _tokens_apart(columns: Iterable[pa.ListArray]) -> Iterator[pa.ListArray]:
    """The lists of columns, cut so that a part has one row or at most ``COUNTED`` tokens."""
    for lists in columns:
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        start = 0
        while start < len(lists):
            done = ends[start - 1] if start else 0
            stop = min(max(start + 1, int(np.searchsorted(ends, done + COUNTED, "right"))), start + ROWS)
            yield lists.slice(start, stop - start)
            start = stop


def _coded(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different tokens of all rows, and of every token its number and its row."""
    encoded = lists.flatten().dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())


def _counted(numbers: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different numbers in order, how often each occurs and in how many rows."""
    both = np.sort(numbers * n_rows + rows)
    new_pair = np.concatenate([np.ones(min(1, len(both)), bool), both[1:] != both[:-1]])
    sorted_numbers = both // n_rows
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(both)), bool), sorted_numbers[1:] != sorted_numbers[:-1]]))
    df = np.add.reduceat(new_pair.astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)
    return sorted_numbers[starts], np.diff(np.append(starts, len(both))), df


def _parts(terms: pa.Array, cf: np.ndarray, df: np.ndarray) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([terms, pa.array(cf, pa.int64()), pa.array(df, pa.int64())], names=["term", "cf", "df"])
    for start in range(0, whole.num_rows, SENT):
        yield whole.slice(start, SENT)


def _count_words(sizes: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in _tokens_apart(batch.column(0) for batch in batches):
            words, code, row = _coded(lists)
            terms, place = words, code
            for n in range(1, sizes[1] + 1):
                if n > 1:  # a gram is its first n - 1 words and the next one, within a row
                    inside = row[n - 1 :] == row[: len(row) - n + 1]
                    place = np.where(inside, place[: len(place) - 1] * len(words) + code[n - 1 :], -1)
                    found, cf, df = _counted(place[inside], row[: len(place)][inside], len(lists))
                    terms = pc.binary_join_element_wise(terms.take(pa.array(found // len(words))), words.take(pa.array(found % len(words))), " ")
                    place = np.searchsorted(found, place) if n < sizes[1] else place
                else:
                    found, cf, df = _counted(code, row, len(lists))
                    terms = words.take(pa.array(found))
                if n >= sizes[0]:
                    yield from _parts(terms, cf, df)

    return run


def _strings(points: np.ndarray) -> pa.Array:
    """Rows of code points as strings."""
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    offsets = np.concatenate([[0], np.cumsum(width.sum(1))]).astype(np.int32)
    data = points.astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(points), pa.py_buffer(offsets), pa.py_buffer(data))


def _cut(chunks: pa.Array, sizes: tuple[int, int]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different grams of padded chunks, the grams of all chunks by number, and where each chunk's begin.

    A gram's number is made of its characters' places in the alphabet at hand. Where such numbers
    grow too long, the shorter grams are numbered anew first, and ``levels`` leads back to them.
    """
    lengths = pc.utf8_length(chunks).to_numpy().astype(np.int64) + 2
    points = np.frombuffer((" " + "  ".join(chunks.to_pylist()) + " ").encode("utf-32-le"), "<u4")[: lengths.sum()]
    alphabet = np.flatnonzero(np.bincount(points))
    places = np.zeros(alphabet[-1] + 1, np.int64)
    places[alphabet] = np.arange(len(alphabet))
    code, letters = places[points], len(alphabet)
    line = np.repeat(np.arange(len(lengths)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))  # characters from here to the end of the line
    number, bound, levels = code, letters, {}
    terms, lines, grams, known = [], [], [], 0
    for n in range(1, sizes[1] + 1):
        if n > 1:
            if bound * letters >= 1 << 62:
                number, levels[n - 1] = pd.factorize(number)
                bound = len(levels[n - 1])
            at = np.flatnonzero(left >= n)
            longer = np.zeros(len(points), np.int64)
            longer[at] = number[at] * letters + code[at + n - 1]
            number, bound = longer, bound * letters
        if n >= sizes[0]:
            at = np.flatnonzero(left >= n)
            place, found = pd.factorize(number[at])
            spelt = np.empty((len(found), n), np.uint32)
            for k in range(n, 0, -1):
                found = levels[k][found] if k in levels and k < n else found
                found, last = np.divmod(found, letters) if k > 1 else (found, found)
                spelt[:, k - 1] = alphabet[last]
            terms.append(_strings(spelt))
            lines.append(line[at])
            grams.append(place + known)
            known += len(spelt)
    by_line = np.argsort(np.concatenate(lines), kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(np.concatenate(lines), minlength=len(lengths)))])
    return pa.concat_arrays(terms), np.concatenate(grams)[by_line], starts


def _opened(pairs: np.ndarray, starts: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Stretches of the chunks named in ``pairs``: their slice, the places of all their grams, and each chunk's number of them."""
    sizes = np.diff(starts)[pairs]
    ends = np.cumsum(sizes)
    start = 0
    while start < len(pairs):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + OPENED, "right")))
        own = sizes[start:stop]
        first = starts[pairs[start:stop]] - (np.cumsum(own) - own)
        yield slice(start, stop), np.arange(own.sum()) + np.repeat(first, own), own
        start = stop


def _count_chars(sizes: tuple[int, int]):
    """A part's different chunks are cut once; a row counts once for each gram that its chunks hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in _tokens_apart(batch.column(0) for batch in batches):
            chunks, code, row = _coded(lists)
            if not len(chunks):
                continue
            terms, grams, starts = _cut(chunks, sizes)
            times = np.repeat(np.bincount(code, minlength=len(chunks)), np.diff(starts))
            cf = np.bincount(grams, times, len(terms)).astype(np.int64)
            df = np.zeros(len(terms), np.int64)
            seen = np.full(len(terms), -1, np.int64)  # the last row that counted for a gram
            pairs = np.sort(row * len(chunks) + code)
            rows, own = np.divmod(pairs[np.append(True, pairs[1:] != pairs[:-1])], len(chunks))
            for part, places, held in _opened(own, starts):
                found, whose = grams[places], np.repeat(rows[part], held)
                for at in np.split(np.arange(len(found)), np.flatnonzero(np.diff(whose)) + 1):
                    gram = found[at[0] : at[-1] + 1]
                    gram = gram[seen[gram] != whose[at[0]]]
                    df[gram] += 1  # once, however often a gram is listed
                    seen[gram] = whose[at[0]]
            yield from _parts(terms, cf, df)

    return run


PARTS = "term string, cf long, df long"


def _word_statistics(df: DataFrame, text_col: str) -> DataFrame:
    """(term, cf, df) parts: the rows of an Arrow batch are counted together."""
    return df.select(word_tokens(F.col(text_col)).alias("_t")).mapInArrow(_count_words(WORD_NGRAMS), PARTS)


def _char_statistics(df: DataFrame, text_col: str) -> DataFrame:
    """(term, cf, df) parts: many rows' different chunks are cut into grams once."""
    return df.select(word_chunks(F.col(text_col)).alias("_t")).mapInArrow(_count_chars(CHAR_NGRAMS), PARTS)


STATISTICS = {"word": _word_statistics, "char": _char_statistics}


def term_statistics(df: DataFrame, kind: str = "word", text_col: str = "clean_text") -> DataFrame:
    """(term, cf, df): corpus count and document count; every row is a document.

    Nothing is moved by document: a task counts the terms of many rows together, and the parts of a
    term meet once, by term.
    """
    parts = STATISTICS[kind](df, text_col)
    return parts.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


# ---- TF-IDF, long form -------------------------------------------------------------------


def _top_terms(stats: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows of a written (term, cf, df) table in the order cf descending, term ascending.

    The count at the cut is found on histograms: first of logarithmic levels, some thousand at most,
    then of the counts within the level of the cut. All terms above it are kept as they lie; only the
    terms of exactly that count are put in order, by ranges.
    """
    level = F.floor(F.log2("cf") * F.lit(LEVELS)).cast("int")
    levels = sorted(stats.groupBy(level.alias("level")).count().collect(), reverse=True)
    if sum(row["count"] for row in levels) <= most:
        return stats
    left, at = most, 0
    while levels[at]["count"] < left:
        left, at = left - levels[at]["count"], at + 1
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("cf"))
    counts = stats.where(level == levels[at]["level"]).groupBy("cf").agg(F.count("*").alias("n"))
    running = counts.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") >= left)
    cut = running.agg(F.max_by(F.struct("cf", (F.lit(left) - F.col("upto") + F.col("n")).alias("ties")), "cf")).first()[0]
    ties = numbered(stats.where(F.col("cf") == cut["cf"]), ["term"], "_rank").where(F.col("_rank") <= cut["ties"])
    return stats.where(F.col("cf") > cut["cf"]).union(ties.select(stats.columns))


def fit_vocabulary(
    df: DataFrame, kind: str = "word", min_df: int = MIN_DF, max_features: int = MAX_FEATURES, text_col: str = "clean_text"
) -> DataFrame:
    """(term, idx, cf, df, idf): the most frequent terms that are in ``min_df`` rows or more.

    The cut is by corpus count, then by term; ``idx`` is alphabetical. At most
    ``max_features`` rows, so the result may be broadcast and numbered in one window. It is
    written once: every consumer reads the fitted rows and none counts the corpus again.
    """
    n_docs = df.count()
    stats = written(term_statistics(df, kind, text_col).where(F.col("df") >= min_df), "term-statistics")
    alphabetical = Window.partitionBy(F.lit(0)).orderBy("term")
    fitted = _top_terms(stats, max_features).select(
        "term",
        (F.row_number().over(alphabetical) - 1).alias("idx"),
        "cf",
        "df",
        (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"),
    )
    return written(fitted, "vocabulary")


def tfidf(df: DataFrame, vocabulary: DataFrame, kind: str = "word", keep: Sequence[str] = (), key: str = "email_id", text_col: str = "clean_text") -> DataFrame:
    """(key, keep, term, idx, weight): counts times idf, each document scaled to length 1.

    Terms are counted inside their row, so no text and no count is shuffled; the names come from the
    vocabulary, which has at most ``max_features`` rows. Terms outside of it drop out.
    """
    vectors = with_vectors(df.select(key, *keep, text_col), vocabulary, kind, text_col)
    names = F.broadcast(vocabulary.select("idx", "term"))
    return vector_entries(vectors, "features", key, keep).join(names, "idx").select(key, *keep, "term", "idx", "weight")


# ---- TF-IDF, vector form -----------------------------------------------------------------


def _counter(terms: list[str], tokens: str, out: str) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary``, which sends a vocabulary term by term, with a single call for all of them.

    No term of either kind holds a line break; terms that did would be sent one by one.
    """
    if not terms or any("\n" in t for t in terms):
        return CountVectorizerModel.from_vocabulary(terms, inputCol=tokens, outputCol=out)
    cut = SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile("\n").split("\n".join(terms), -1)
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", cut)
    model._set(vocabSize=len(terms))
    return model.setInputCol(tokens).setOutputCol(out)


def vectoriser(
    vocabulary: DataFrame, kind: str = "word", text_col: str = "clean_text", out: str = "features"
) -> PipelineModel:
    """A saved-and-loadable transformer giving the same weights as ``tfidf`` as sparse vectors.

    The vocabulary is collected: it has at most ``max_features`` rows.
    """
    terms = sorted(vocabulary.select("idx", "term", "idf").collect())
    spark_terms, counts, weighted = f"_{out}_terms", f"_{out}_tf", f"_{out}_tfidf"
    if kind == "word":
        tokens, pairs = f"_{out}_tokens", f"_{out}_pairs"
        cut = [
            RegexTokenizer(inputCol=text_col, outputCol=tokens, gaps=False, pattern=VECTOR_TOKEN, toLowercase=True),
            NGram(n=2, inputCol=tokens, outputCol=pairs),
            SQLTransformer(statement=f"SELECT *, concat({tokens}, {pairs}) AS {spark_terms} FROM __THIS__"),
        ]
        used = [tokens, pairs]
    else:
        cut, used = [SQLTransformer(statement=_char_statement(text_col, spark_terms))], []
    stages = cut + [
        _counter([r.term for r in terms], spark_terms, counts),
        ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in terms]), inputCol=counts, outputCol=weighted),
        Normalizer(p=2.0, inputCol=weighted, outputCol=out),
        SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(used + [spark_terms, counts, weighted])}) FROM __THIS__"),
    ]
    return PipelineModel(stages)


def with_vectors(df: DataFrame, vocabulary: DataFrame, kind: str = "word", text_col: str = "clean_text", out: str = "features") -> DataFrame:
    """``df`` with the vectors of ``vectoriser``; character grams are cut from many rows' different chunks at once.

    The vocabulary is collected: it has at most ``max_features`` rows.
    """
    if kind == "word":
        return vectoriser(vocabulary, kind, text_col, out).transform(df)
    rows = sorted(vocabulary.select("idx", "term", "idf").collect())
    fitted = df.sparkSession.sparkContext.broadcast(([r.term for r in rows], np.array([r.idf for r in rows], float)))

    @F.arrow_udf(VectorUDT())
    def weigh(chunks: pa.Array) -> pa.Array:
        terms, idf = pa.array(fitted.value[0], pa.string()), fitted.value[1]
        parts = [weights for lists in _tokens_apart([chunks]) for weights in _char_weights(lists, terms, idf)]
        sizes, indices, values = (np.concatenate([*column, np.empty(0, kind)]) for column, kind in zip(zip(*parts) if parts else ((), (), ()), (np.int64, np.int32, float)))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(len(sizes), np.int8)), pa.array(np.full(len(sizes), len(idf), np.int32)),
             pa.ListArray.from_arrays(offsets, pa.array(indices)), pa.ListArray.from_arrays(offsets, pa.array(values))],
            names=["type", "size", "indices", "values"],
        )

    return df.withColumn(out, weigh(word_chunks(F.col(text_col))))


def _char_weights(lists: pa.ListArray, terms: pa.Array, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(entries of each row, their terms, their weights) for stretches of rows with about ``OPENED`` grams in all."""
    chunks, code, row = _coded(lists)
    if not len(chunks) or not len(terms):
        yield np.zeros(len(lists), np.int64), np.empty(0, np.int32), np.empty(0)
        return
    found, grams, starts = _cut(chunks, CHAR_NGRAMS)
    idx = pc.fill_null(pc.index_in(found, terms), -1).to_numpy()[grams]
    idx, starts = idx[idx >= 0].astype(np.int64), np.concatenate([[0], np.cumsum(idx >= 0)])[starts]
    sizes = np.diff(starts)[code]
    of_row = np.bincount(row, sizes, len(lists)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(of_row) // OPENED)) + 1
    for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lists)]):
        at = slice(*np.searchsorted(row, [first, end]))
        own = sizes[at]
        places = np.arange(own.sum()) + np.repeat(starts[code[at]] - (np.cumsum(own) - own), own)
        keys = np.sort(np.repeat(row[at] - first, own) * len(terms) + idx[places])
        heads = np.flatnonzero(np.append(np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]))
        whose, term = np.divmod(keys[heads], len(terms))
        weights = np.diff(np.append(heads, len(keys))) * idf[term]
        length = np.sqrt(np.bincount(whose, weights * weights, end - first))
        yield np.bincount(whose, minlength=end - first), term.astype(np.int32), weights / length[whose]


def _char_statement(text_col: str, out: str) -> str:
    """The character-gram expression as SQL, so that the transformer can be saved."""
    low, high = CHAR_NGRAMS
    space = SPACE.replace("\\", "\\\\")
    chunks = f"filter(split(lower(coalesce({text_col}, '')), '{space}+'), w -> w <> '')"
    lines = f"concat(' ', array_join({chunks}, ' \\n '), ' ')"
    grams = ", ".join("regexp_extract_all(_lines, '" + GRAM.format(n=n).replace("\\", "\\\\") + "', 1)" for n in range(low, high + 1))
    return f"SELECT * EXCEPT (_lines), concat({grams}) AS {out} FROM (SELECT *, {lines} AS _lines FROM __THIS__)"


# ---- scaling -----------------------------------------------------------------------------


def fit_scaler(df: DataFrame, columns: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """(feature, mean, scale): population deviation, 1 where a feature is constant."""
    stats = df.agg(
        *[F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"),
                 F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("scale"))
        for i, c in enumerate(columns)
    ])
    return stats.select(F.explode(rows).alias("r")).select("r.*")


def apply_scaler(df: DataFrame, scaler: DataFrame, with_mean: bool = True, columns: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """Columns replaced by their scaled values; the scaler has one row per column and is collected."""
    fitted = {row.feature: row for row in scaler.collect()}
    scaled = {}
    for c in columns:
        value = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        shifted = value - F.lit(fitted[c].mean) if with_mean else value
        scaled[c] = shifted / F.lit(fitted[c].scale)
    return df.withColumns(scaled)


def hybrid(df: DataFrame, columns: Sequence[str] = FEATURE_NAMES, word: str = "word", char: str = "char", out: str = "hybrid") -> DataFrame:
    """Word vector, character vector and scaled structured columns side by side."""
    return VectorAssembler(inputCols=[word, char, *columns], outputCol=out).transform(df)


# ---- SVD ---------------------------------------------------------------------------------


def fit_svd(df: DataFrame, vector_col: str = "features", k: int = SVD_COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Leading singular values and right vectors of the uncentred row matrix.

    The distributed rows are multiplied with many vectors in a pass; the driver holds vocabulary x ``3 k`` numbers.
    """
    return factor.fit(df, vector_col, k)


def apply_svd(df: DataFrame, right: np.ndarray, vector_col: str = "features", out: str = "svd") -> DataFrame:
    """Rows times the right vectors, in Arrow batches against one broadcast matrix.

    The matrix is vocabulary x k numbers, whatever the size of the data.
    """
    return projected(df, right, vector_col, out).withColumn(out, array_to_vector(out))


def projected(df: DataFrame, right: np.ndarray, vector_col: str, out: str) -> DataFrame:
    """``apply_svd`` with an array of numbers instead of a vector."""
    matrix = df.sparkSession.sparkContext.broadcast(right)

    @F.pandas_udf("array<double>")
    def project(vectors: pd.DataFrame) -> pd.Series:
        out = np.zeros((len(vectors), right_columns))
        for rows, starts, positions, values in _stretches(vectors):
            out[rows] = np.add.reduceat(values[:, None] * matrix.value[positions], starts)
        return pd.Series(list(out))

    right_columns = right.shape[1]
    return df.withColumn(out, project(F.col(vector_col)))


def _stretches(vectors: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, starts, positions, values) of runs of vectors with about ``STRETCH`` entries in all.

    Arrow delivers a vector as its four fields; vectors without entries are left out.
    """
    values = [np.asarray(v, dtype=float) for v in vectors["values"]]
    positions = [np.arange(len(v)) if p is None else np.asarray(p, dtype=int) for p, v in zip(vectors["indices"], values)]
    sizes = np.array([len(v) for v in values], dtype=int)
    filled = np.flatnonzero(sizes)
    for rows in np.split(filled, np.flatnonzero(np.diff(np.cumsum(sizes[filled]) // STRETCH)) + 1):
        if len(rows):
            starts = np.cumsum(sizes[rows]) - sizes[rows]
            yield rows, starts, np.concatenate([positions[i] for i in rows]), np.concatenate([values[i] for i in rows])


# ---- vectors to rows ---------------------------------------------------------------------


def vector_entries(df: DataFrame, vector_col: str, key: str = "email_id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep, idx, weight) rows of a vector column. A sparse vector is never made dense."""
    opened = df.select(key, *keep, F.unwrap_udt(vector_col).alias("_u"))
    values = F.col("_u.values")
    dense = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
    pairs = opened.select(key, *keep, F.coalesce("_u.indices", dense).alias("_i"), values.alias("_v"))
    entries = pairs.select(key, *keep, F.explode(F.arrays_zip("_i", "_v")).alias("_e"))
    return entries.select(key, *keep, F.col("_e._i").alias("idx"), F.col("_e._v").alias("weight"))


def block_sizes(vocab_sizes: dict[str, Column], split: DataFrame) -> DataFrame:
    """Feature dimensions and split sizes as (metric, value)."""
    counted = split.agg(*[F.count_if(F.col("split") == s).alias(f"{s}_size") for s in ("train", "valid", "test")])
    with_dims = counted.select(*[c.alias(n) for n, c in vocab_sizes.items()], *counted.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in with_dims.columns])
    return with_dims.select(F.explode(pairs).alias("m")).select("m.*")


def sample_check(train: DataFrame, blocks: Sequence[str] = ("word", "char", "structured", "hybrid", "svd")) -> DataFrame:
    """The first rows by id beside the block names, joined by row number."""
    names = train.sparkSession.createDataFrame(
        [(i + 1, b) for i, b in enumerate(blocks)], "position int, feature_block string"
    )
    first = train.select("email_id", "label", "source_dataset").orderBy("email_id").limit(len(blocks))
    numbered = first.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("email_id")))
    return numbered.join(F.broadcast(names), "position").drop("position")
