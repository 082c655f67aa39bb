"""Token counts that follow edits: segment trees over pre-tokens.

A byte-pair tokenizer splits a text into pre-tokens and encodes each on its own, so a text's count is
the sum over its pre-tokens. A document's state is a segment tree: leaves are blocks of up to
``LEAF`` pre-tokens with their characters and tokens, inner nodes are sums. An edit descends to the
leaf where it begins, steps back over the pre-tokens that may look into it, re-encodes from there
until the new pre-tokens meet an old boundary behind the edit, and updates the sums on the paths of
the leaves it touched. Nothing else is encoded again.

The pre-token pattern looks at most two characters ahead, and what it takes from a boundary on does
not depend on what lies before. Old pre-tokens that end two characters before an edit are kept.

State and edits are tables: ``build`` makes the state, ``apply_edits`` takes a state and the edits
of each row, and gives the next state. Edits are positions in the text before any of them, do not
overlap, and are applied from the last to the first.

Defined results: a null text is empty; an edit beyond the end is cut to it; overlapping edits raise an
error; rows with equal ids keep their own states; an empty table gives none.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from mailsift.llm.common import text_slices

TOKENIZER = "byte_bpe_50k.tiktoken"
LEAF = 32
AHEAD = 2  # characters behind its end that a pre-token can depend on
CACHED = 200_000


class Counter:
    """Tokens of pre-tokens; the counts of recent ones are kept."""

    def __init__(self, path: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(TOKENIZER), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}
        self.encoded = 0  # characters given to the tokenizer or its cache

    def counts(self, pieces: list[str]) -> list[int]:
        if len(self.known) > CACHED:
            self.known.clear()
        known, encode = self.known, self.encoding.encode_ordinary
        out = []
        for piece in pieces:
            count = known.get(piece)
            if count is None:
                count = known[piece] = len(encode(piece))
            out.append(count)
        self.encoded += sum(map(len, pieces))
        return out


class Tree:
    """Sums of (characters, tokens) over leaves, as a heap: node i has the children 2i and 2i + 1."""

    def __init__(self, leaves: np.ndarray) -> None:
        self.size = 1 << max(0, (len(leaves) - 1).bit_length())
        self.nodes = np.zeros((2 * self.size, 2), np.int64)
        self.nodes[self.size : self.size + len(leaves)] = leaves
        at = self.size
        while at > 1:
            half = at // 2
            self.nodes[half:at] = self.nodes[at : 2 * at : 2] + self.nodes[at + 1 : 2 * at : 2]
            at = half

    @classmethod
    def load(cls, flat: np.ndarray) -> Tree:
        tree = cls.__new__(cls)
        tree.nodes = flat.reshape(-1, 2).copy()
        tree.size = len(tree.nodes) // 2
        return tree

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and the characters before the leaf."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if position >= before + self.nodes[node, 0] and self.nodes[node + 1, 0]:
                before += int(self.nodes[node, 0])
                node += 1
        return node - self.size, before

    def set(self, leaf: int, characters: int, tokens: int) -> None:
        node = self.size + leaf
        change = np.array([characters, tokens]) - self.nodes[node]
        while node:
            self.nodes[node] += change
            node //= 2

    @property
    def tokens(self) -> int:
        return int(self.nodes[1, 1])


def grow(text: str, counter: Counter) -> Tree:
    pieces = counter.pattern.findall(text)
    lengths, counts = np.array([*map(len, pieces)], np.int64), np.array(counter.counts(pieces), np.int64)
    if not pieces:
        return Tree(np.zeros((1, 2), np.int64))
    starts = np.arange(0, len(pieces), LEAF)
    return Tree(np.stack([np.add.reduceat(lengths, starts), np.add.reduceat(counts, starts)], 1))


def edit(text: str, tree: Tree, start: int, end: int, new: str, counter: Counter) -> str:
    """The edited text; the tree is brought up to date."""
    start, end = min(start, len(text)), min(end, len(text))
    # From a leaf whose pre-tokens before the edit cannot look into it, to one behind it.
    first, before = tree.find(max(0, start - AHEAD - 1))
    if before and start - AHEAD < before + 1:
        first, before = tree.find(before - 1)
    edited = text[:start] + new + text[end:]
    shift = len(new) - (end - start)
    last, base = tree.find(min(end, max(0, len(text) - 1)))
    border = base + int(tree.nodes[tree.size + last, 0])  # old end of the last touched leaf
    pieces: list[str] = []
    at = before
    while at < len(edited):
        if at >= border + shift:
            if at == border + shift:
                break
            last += 1  # no old boundary here: take in the next leaf
            border += int(tree.nodes[tree.size + last, 0])
            continue
        match = counter.pattern.match(edited, at)
        pieces.append(match.group())
        at = match.end()
    tree.set(first, sum(map(len, pieces)), sum(counter.counts(pieces)))
    for leaf in range(first + 1, last + 1):
        tree.set(leaf, 0, 0)
    return edited


TREE = [StructField("tokens", LongType()), StructField("nodes", ArrayType(LongType()))]


def build(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(row, text, tokens, nodes): every row of ``docs`` as a struct, with its tree."""
    rows = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in text_slices(batches):
            yield _state(batch, [grow(t, counter) for t in batch.column("text").to_pylist()], batch.column("text"), [])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *TREE]))


def _state(batch: pa.RecordBatch, trees: list[Tree], texts: pa.Array, more: list[tuple[str, pa.Array]]) -> pa.RecordBatch:
    flat = [t.nodes.ravel() for t in trees]
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in flat])]).astype(np.int32)
    nodes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64)))
    columns = [("row", batch.column("row")), ("text", texts), *more, ("tokens", pa.array([t.tokens for t in trees], pa.int64())), ("nodes", nodes)]
    return pa.RecordBatch.from_arrays([c for _, c in columns], names=[n for n, _ in columns])


def apply_edits(state: DataFrame, edits: Column, tokenizer: str | None = None) -> DataFrame:
    """The next state and ``encoded``, the characters that were encoded again.

    ``edits`` is an array<struct<start int, end int, new string>> over the state's columns; from a
    table of edits, it is what one join on the row's id and one ``collect_list`` give.
    """
    rows = state.select("row", "text", "tokens", "nodes", edits.alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in text_slices(batches):
            trees, texts, encoded = [], [], []
            lists = batch.column("nodes")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, (text, changes) in enumerate(zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist())):
                tree = Tree.load(flat[offsets[i] : offsets[i + 1]])
                before, limit = counter.encoded, len(text)
                for change in sorted(changes or [], key=lambda c: (c["start"], c["end"]), reverse=True):
                    if min(change["end"], len(text)) > limit and change["start"] < limit:
                        raise ValueError("edits overlap")
                    limit = change["start"]
                    text = edit(text, tree, change["start"], change["end"], change["new"] or "", counter)
                trees.append(tree)
                texts.append(text)
                encoded.append(counter.encoded - before)
            yield _state(batch, trees, pa.array(texts, pa.string()), [("encoded", pa.array(encoded, pa.int64()))])

    return rows.mapInArrow(run, StructType([*rows.select("row", "text").schema.fields, StructField("encoded", LongType()), *TREE]))


def sample_edits(text: Column) -> Column:
    """Two edits of an editing pass: twelve code points at a third of the text go, and a remark is put in at two thirds."""
    third = F.floor(F.length(text) / 3).cast("int")
    edit_ = lambda start, end, new: F.struct(start.alias("start"), end.alias("end"), F.lit(new).alias("new"))
    cut = F.least(third + 12, 2 * third)
    return F.array(edit_(third, cut, ""), edit_(2 * third, 2 * third, " [edited] "))


def result(docs: DataFrame) -> DataFrame:
    """Tokens of every document before and after the edits, and the characters encoded for them."""
    state = build(docs.select("doc_id", "text"))
    # The count before the edits travels in the row.
    state = state.withColumn("row", F.struct("row.doc_id", F.col("tokens").alias("before")))
    after = apply_edits(state, sample_edits(F.col("text")))
    return after.select("row.doc_id", F.col("row.before").alias("n_tokens"), F.col("tokens").alias("n_tokens_edited"), F.col("encoded").alias("n_chars_encoded"))
