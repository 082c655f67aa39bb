"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailsift.llm import language_id, mixing, ngram_join, packing, pii
from mailsift.session import checkpoint_dir

LEAST_CERTAINTY = 0.4  # a document whose words are on average less likely than this to be in any one language is rejected
SHINGLE, NUMERATOR, DENOMINATOR = 5, 8, 10  # five words, similarity of 0.8 or more


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay, with the predicted one where ``lang`` is null; the others go.

    Texts that switch languages stay: each word counts by its own language. Null texts and texts without
    letters go; repeated rows are judged alike; an empty table stays empty.
    """
    model = language_id.fit(language_id.training_segments(docs.select("doc_id", "text", "lang")))
    found = language_id.identify(docs, model).where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("certainty") >= LEAST_CERTAINTY))
    return found.select(*[
        F.coalesce(F.col("row.lang"), F.col("lang_pred")).alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns
    ])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return ngram_join.deduplicated(docs, n=SHINGLE, numerator=NUMERATOR, denominator=DENOMINATOR)


def sanitise_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that give it away are replaced in the texts; ``n_chars`` follows."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the mix with its place in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("pii", sanitise_personal_data),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

ORACLE_SQL = None  # a fitted classifier, a tokenizer and packing are no SQL: see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
