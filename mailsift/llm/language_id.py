"""Language identification of words by a linear-chain conditional random field.

A text is a chain of words; every word with a letter has a language as its label. Affixes, letter
n-grams and a lexicon of frequent training words give each word a score per language, learned
transitions tie neighbours, and forward-backward gives the probability of each language at each
word, also where a text switches. A document's language is the one with the largest mean
probability over its words, which is its score; its ``certainty`` is the mean of each word's own largest
probability, which stays high where a text switches. ``runs`` are the words' labels, as counts of
consecutive words of one language.

Training takes a bounded sample: at most ``DOCS`` documents of each language, by hash, of each at
most ``SEGMENTS`` segments of ``SEGMENT`` words spread over the whole text; the sample's size does
not depend on the table's. Segments of random languages are chained, so that the transitions see
switches. Tables grow with the labels found, the work with their square. The fit is adaptive-gradient ascent of the chain's likelihood with a small L2 penalty.
Prediction covers every word of every text, in tasks that hold the fitted tables.

Defined results: a text that is null or has no letter is ``und`` with score 0; equal scores go to the
first language in order; without labelled training text everything is ``und``; rows with equal or
null ids are rows of their own (a null id counts as held out of training); an empty table gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from mailsift.llm.common import SPACE, text_slices

DOCS = 300  # per language
SEGMENTS, SEGMENT = 6, 24
FEATURES = 1 << 15
LEXICON = 2  # times a word must occur in the sample
EPOCHS, RATE, PENALTY = 6, 0.25, 1e-6
UNKNOWN = "und"
LABELLED_CHARS = 1_000_000  # text that a task labels at once
CHAIN = 64  # words of a chain that are handled at once
CACHED_WORDS = 200_000


def letters_of(word: str) -> str:
    """The word's letters in lower case."""
    return word.lower() if word.isalpha() else "".join(filter(str.isalpha, word.lower()))


class Places(dict):
    """Places of feature names, as far as they were met."""

    def __missing__(self, name: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        place = self[name] = xxh3_64_intdigest(name) % FEATURES
        return place


PLACES = Places()


def word_features(word: str, lexicon: frozenset[str] | set[str]) -> list[int]:
    """Hashed features: affixes of one to three letters, n-grams of one to three, and the word if known."""
    pairs = list(map(add, word, word[1:]))
    names = {
        *word, *pairs, *map(add, pairs, word[2:]), "<" + word[:1], "<" + word[:2], "<" + word[:3], word[-1:] + ">", word[-2:] + ">",
        word[-3:] + ">", "=" + word if word in lexicon else "=",
    }
    return [PLACES[n] for n in names]


class Model:
    """Weights per (feature, language), transitions, and the lexicon."""

    def __init__(self, languages: list[str], lexicon: frozenset[str]) -> None:
        self.languages, self.lexicon = languages, lexicon
        self.weights = np.zeros((FEATURES, len(languages)), np.float32)
        self.transitions = np.zeros((len(languages), len(languages)))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score per word and language, each word once."""
        features = [word_features(w, self.lexicon) for w in words]
        sizes = np.array([len(f) for f in features])
        flat = np.fromiter(chain.from_iterable(features), np.int64, int(sizes.sum())) if features else np.empty(0, int)
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(self.weights[flat], starts).astype(np.float64) / np.sqrt(sizes)[:, None] if len(flat) else np.empty((0, len(self.languages)))


def forward_backward(scores: np.ndarray, transitions: np.ndarray, mask: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Marginals (chains, words, languages), and the scaled forward, backward and potentials.

    All chains have one length; a word outside ``mask`` carries the label on without a choice.
    """
    chains, length, k = scores.shape
    potential = np.exp(scores - scores.max(2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    alpha, beta = np.empty_like(potential), np.empty_like(potential)
    ahead = np.full((chains, k), 1.0 / k)
    for t in range(length):
        step = (ahead if t == 0 else ahead @ move) * potential[:, t]
        if mask is not None:
            step = np.where(mask[:, t, None], step, ahead)
        ahead = step / step.sum(1, keepdims=True)
        alpha[:, t] = ahead
    back = np.ones((chains, k))
    for t in range(length - 1, -1, -1):
        beta[:, t] = back
        step = (potential[:, t] * back) @ move.T
        if mask is not None:
            step = np.where(mask[:, t, None], step, back)
        back = step / step.sum(1, keepdims=True)
    marginal = alpha * beta
    return marginal / marginal.sum(2, keepdims=True), alpha, beta, potential


def fit(segments: list[tuple[str, list[str]]], seed: int = 42) -> Model | None:
    """Fit on (language, words) segments; None without any."""
    segments = [(lang, [x for w in words if (x := letters_of(w))]) for lang, words in segments]
    segments = sorted((s for s in segments if s[1]), key=repr)
    if not segments:
        return None
    languages = sorted({lang for lang, _ in segments})
    counts = Counter(w for _, words in segments for w in words)
    model = Model(languages, frozenset(w for w, n in counts.items() if n >= LEXICON))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(segments))
    number = {lang: i for i, lang in enumerate(languages)}
    words = [w for i in order for w in segments[i][1]]
    labels = np.concatenate([np.full(len(segments[i][1]), number[segments[i][0]]) for i in order])
    cut = len(words) // CHAIN * CHAIN or len(words)
    length = CHAIN if len(words) >= CHAIN else len(words)
    codes, distinct = pd.factorize(np.array(words[:cut], object))
    features = [word_features(w, model.lexicon) for w in distinct]
    widest = max(map(len, features))
    padded = np.full((len(features), widest), FEATURES)
    for i, f in enumerate(features):
        padded[i, : len(f)] = f
    scale = 1 / np.sqrt([len(f) for f in features])
    chains, gold = codes.reshape(-1, length), labels[:cut].reshape(-1, length)
    k = len(languages)
    weights = np.zeros((FEATURES + 1, k))
    squares, move_squares = np.full((FEATURES + 1, k), 1e-6), np.full((k, k), 1e-6)
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // 64)):
            used, place = np.unique(chains[batch], return_inverse=True)
            emission = weights[padded[used]].sum(1) * scale[used][:, None]
            scores = emission[place].reshape(len(batch), length, k)
            marginal, alpha, beta, potential = forward_backward(scores, model.transitions)
            target = np.eye(k)[gold[batch]]
            miss = (target - marginal).reshape(-1, k)
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, place.ravel(), miss)
            gradient = np.zeros_like(weights)
            np.add.at(gradient, padded[used], (by_word * scale[used][:, None])[:, None, :])
            gradient[FEATURES] = 0
            move = np.exp(model.transitions - model.transitions.max())
            pair = alpha[:, :-1, :, None] * move * (potential[:, 1:] * beta[:, 1:])[:, :, None, :]
            pair /= pair.sum((2, 3), keepdims=True)
            seen = np.einsum("nti,ntj->ij", target[:, :-1], target[:, 1:])
            move_gradient = seen - pair.sum((0, 1))
            gradient = gradient / len(batch) - PENALTY * weights
            move_gradient = move_gradient / len(batch) - PENALTY * model.transitions
            squares += gradient**2
            move_squares += move_gradient**2
            weights += RATE * gradient / np.sqrt(squares)
            model.transitions = model.transitions + RATE * move_gradient / np.sqrt(move_squares)
    model.weights = weights[:FEATURES].astype(np.float32)
    return model


class Labeller:
    """Mean language probabilities of whole texts; the scores of recent words are kept."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.rows: dict[str, int] = {}
        self.scores = np.empty((0, len(model.languages)))

    def _codes(self, words: list[str]) -> np.ndarray:
        """Row of each word in ``scores``; -1 for a word without letters."""
        met = set(words)
        new = met.difference(self.rows)
        if len(self.rows) + len(new) > CACHED_WORDS:  # only the words at hand stay
            kept = [w for w in met if w in self.rows]
            places = np.array([self.rows[w] for w in kept], np.int64)
            used = np.unique(places[places >= 0])
            self.scores = self.scores[used]
            self.rows = {w: int(np.searchsorted(used, p)) if p >= 0 else -1 for w, p in zip(kept, places.tolist())}
        if new:
            plain = {w: w.lower() if w.isalpha() else letters_of(w) for w in new}
            some = list({x for x in plain.values() if x})
            start = len(self.scores)
            self.scores = np.concatenate([self.scores, self.model.emissions(some)])
            place = dict(zip(some, range(start, len(self.scores)))) | {"": -1}
            self.rows.update((w, place[x]) for w, x in plain.items())
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float], list[list[dict]]]:
        """Language, score, certainty and runs of every text."""
        split = [(t or "").split() for t in texts]
        codes = self._codes([w for words in split for w in words])
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in split])
        owner, codes = owner[codes >= 0], codes[codes >= 0]
        total, sure = np.zeros((len(texts), len(self.model.languages))), np.zeros(len(texts))
        runs: list[list[dict]] = [[] for _ in texts]
        if len(codes):
            marginal = self._marginals(owner, codes)
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            total[owner[heads]] = np.add.reduceat(marginal, heads)
            labels = marginal.argmax(1)
            sure[owner[heads]] = np.add.reduceat(marginal.max(1), heads)
            turns = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (labels[1:] != labels[:-1])]))
            sizes = np.diff(np.append(turns, len(labels)))
            for whose, name, size in zip(owner[turns].tolist(), labels[turns].tolist(), sizes.tolist()):
                runs[whose].append({"lang": self.model.languages[name], "words": size})
        count = np.bincount(owner, minlength=len(texts))
        mean, sure = total / np.maximum(count, 1)[:, None], sure / np.maximum(count, 1)
        best = mean.argmax(1)
        return (
            [self.model.languages[b] if n else UNKNOWN for b, n in zip(best, count)],
            [min(1.0, float(mean[i, b])) if n else 0.0 for i, (b, n) in enumerate(zip(best, count))],
            np.minimum(sure, 1.0).tolist(), runs,
        )

    def _marginals(self, owner: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Exact marginals of all chains of a batch, ``CHAIN`` words of every chain at a time.

        A long chain is cut into blocks; a block's product of potentials maps what enters it to what
        leaves it, so the messages at all block ends come from a short pass over the blocks.
        """
        k = len(self.model.languages)
        sizes = np.bincount(owner)
        sizes = sizes[sizes > 0]
        blocks = -(-sizes // CHAIN)
        first = np.cumsum(blocks) - blocks
        within = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        row, column = np.repeat(first, sizes) + within // CHAIN, within % CHAIN
        potential = np.ones((blocks.sum(), CHAIN, k))
        mask = np.zeros((blocks.sum(), CHAIN), bool)
        scores = self.scores[codes]
        potential[row, column], mask[row, column] = np.exp(scores - scores.max(1, keepdims=True)), True
        move = np.exp(self.model.transitions - self.model.transitions.max())
        enter = np.full((len(potential), k), 1.0 / k)  # forward message into a block, before its first move
        leave = np.ones((len(potential), k))  # backward message out of a block
        if (blocks > 1).any():
            product = np.broadcast_to(np.eye(k), (len(potential), k, k)).copy()
            for t in range(CHAIN):
                start = move if t else np.eye(k)
                step = (product @ start) * potential[:, t, None, :]
                step = np.where(mask[:, t, None, None], step, product)
                product = step / step.sum((1, 2), keepdims=True)
            last = first + blocks - 1
            for b in range(1, blocks.max()):
                more = np.flatnonzero(blocks > b)
                at = first[more] + b
                previous = at - 1
                out = np.einsum("ni,nij->nj", enter[previous], product[previous])
                enter[at] = out @ move
                enter[at] /= enter[at].sum(1, keepdims=True)
            for b in range(1, blocks.max()):
                more = np.flatnonzero(blocks > b)
                at = last[more] - b  # the block before the one whose message is known
                inner = np.einsum("nij,nj->ni", product[at + 1], leave[at + 1])
                leave[at] = inner @ move.T
                leave[at] /= leave[at].sum(1, keepdims=True)
        alpha = np.empty_like(potential)
        ahead = enter
        for t in range(CHAIN):
            step = (ahead @ move if t else ahead) * potential[:, t]
            step = np.where(mask[:, t, None], step, ahead)
            ahead = step / step.sum(1, keepdims=True)
            alpha[:, t] = ahead
        back = leave
        for t in range(CHAIN - 1, -1, -1):
            alpha[:, t] *= back
            step = (potential[:, t] * back) @ move.T
            step = np.where(mask[:, t, None], step, back)
            back = step / step.sum(1, keepdims=True)
        marginal = alpha[row, column]
        return marginal / marginal.sum(1, keepdims=True)


def training_segments(docs: DataFrame, per_language: int = DOCS) -> list[tuple[str, list[str]]]:
    """The bounded sample: (language, words) segments of documents that are not held out."""
    usable = docs.where((F.col("lang").isNotNull()) & F.col("text").isNotNull() & ~held_out())
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    if not counts:
        return []
    # A document is in the sample if its hash is below the share that gives some more than wanted.
    share = F.element_at(F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 1.3 * per_language / r["n"])))]), F.col("lang"))
    luck = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    words = F.split("text", SPACE)
    step = F.greatest(F.lit(1), F.floor(F.size("words") / F.lit(SEGMENTS)).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), lambda i: F.slice("words", (i * step + 1).cast("int"), F.lit(SEGMENT)))
    sample = (
        usable.select("lang", luck.alias("luck"), "text", share.alias("share")).where(F.col("luck") < F.col("share"))
        .withColumn("words", words).select("lang", "luck", F.filter(cut, lambda s: F.size(s) > 0).alias("segments"))
    )
    rows = sample.orderBy("luck").limit(2 * per_language * len(counts)).collect()
    taken: Counter = Counter()
    out = []
    for row in rows:
        if taken[row["lang"]] < per_language:
            taken[row["lang"]] += 1
            out += [(row["lang"], segment) for segment in row["segments"]]
    return out


def held_out():
    """Documents whose crc32 of the id, as text, leaves 1 by 3; null ids are held out as well."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))


RUNS = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))


def identify(docs: DataFrame, model: Model | None, keep: Sequence[str] | None = None) -> DataFrame:
    """(row, lang_pred, score, certainty, runs): every row of ``docs`` as a struct of its ``keep`` columns (all), with its language."""
    kept = list(keep or docs.columns)
    runs = "array<struct<lang:string,words:bigint>>"
    if model is None:
        return docs.select(
            F.struct(*kept).alias("row"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("certainty"),
            F.array().cast(runs).alias("runs"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is kept goes to the task once, inside of its row.
    rows = docs.select(F.struct(*kept).alias("row"), *([] if "text" in kept else ["text"]))
    chars = max(1, 16 * LABELLED_CHARS // max(16, len(model.languages)))

    def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            yield batch if "text" not in kept else pa.RecordBatch.from_arrays([row, row.field(kept.index("text"))], names=["row", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in text_slices(with_text(batches), most=chars):
            languages, scores, sure, parts = labeller.label(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.float64()),
                 pa.array(parts, RUNS)], names=["row", "lang_pred", "score", "certainty", "runs"],
            )

    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double").add("certainty", "double")
    schema = schema.add("runs", docs.sparkSession.range(0).select(F.array().cast(runs).alias("x")).schema["x"].dataType)
    return rows.mapInArrow(run, schema)


def result(docs: DataFrame) -> DataFrame:
    """The language of every document, and its words' labels as ``lang:words`` runs."""
    model = fit(training_segments(docs.select("doc_id", "text", "lang")))
    labelled = identify(docs.select("doc_id", "text").withColumn("held_out", held_out()), model, ("doc_id", "held_out"))
    parts = F.transform("runs", lambda r: F.concat_ws(":", r["lang"], r["words"].cast("string")))
    return labelled.select("row.doc_id", "row.held_out", "lang_pred", "score", "certainty", F.array_join(parts, ",").alias("runs"))
