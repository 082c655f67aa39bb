"""The 20-field mail record, built the same way from every source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mailsift.config import ID_PREFIX_CHARS, MIN_BODY_CHARS
from mailsift.functions import text as X
from mailsift.schema import EMAIL_RECORD
from mailsift.session import written
from mailsift.sources.mail_files import sender_from_path
from mailsift.sources.tables import label_of

COPIES_PER_TASK = 100_000


def record_id(*parts: Column, sep: str) -> Column:
    return X.sha256_text(F.concat_ws(sep, *parts))


def id_prefix(clean: Column) -> Column:
    return F.substring(clean, 1, ID_PREFIX_CHARS)


def long_enough(clean: Column, min_chars: int = MIN_BODY_CHARS) -> Column:
    return F.length(clean) >= min_chars


def finish_record(df: DataFrame, raw_root: str = "raw", clean_root: str = "clean") -> DataFrame:
    """Add hashes, groups and logical paths, and project to the record schema.

    ``df`` has email_id, source_dataset, label, subject, sender, date, message_id, raw_text,
    clean_text, has_html, attachment_hint and is_corrupted.
    """
    body = df.withColumn("body_group", X.body_hash(F.col("clean_text")))
    file_name = [F.lit("/"), F.col("source_dataset"), F.lit("/"), F.col("email_id"), F.lit(".txt")]
    full = body.withColumns(
        {
            "source_label": F.when(F.col("label") == 1, "spam").otherwise("ham"),
            "raw_path": F.concat(F.lit(raw_root), *file_name),
            "clean_path": F.concat(F.lit(clean_root), *file_name),
            "thread_group": X.thread_group(F.col("subject"), F.col("sender"), F.col("body_group")),
            "sender_group": X.sender_group(F.col("sender")),
            "subject_group": X.subject_hash(F.col("subject")),
            "duplicate_group": F.col("body_group"),
        }
    )
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EMAIL_RECORD.fields])


def number_copies(df: DataFrame, digest_col: str = "_digest") -> DataFrame:
    """Give equal rows the numbers 0, 1, 2, ... in ``copy_no``.

    Only digests are counted, and only those that repeat are written. All other rows stay where they
    are, by an anti-join on the digest; a repeated row is fetched once and written out again in chunks
    of bounded size, so one row repeated a billion times is neither one group nor one task.
    """
    columns = [c for c in df.columns if c != digest_col]
    keyed = df.withColumn(digest_col, F.sha2(F.to_json(F.struct(*columns)), 256))
    counted = keyed.groupBy(digest_col).agg(F.count("*").alias("_n"))
    repeated = written(counted.filter("_n > 1"), "repeated")
    single = keyed.join(repeated, digest_col, "left_anti").select(*columns, digest_col, F.lit(0).cast("bigint").alias("copy_no"))
    copies = keyed.join(repeated, digest_col, "left_semi").groupBy(digest_col).agg(*[F.any_value(c).alias(c) for c in columns])
    last_chunk = F.floor((F.col("_n") - 1) / COPIES_PER_TASK)
    chunks = copies.join(repeated, digest_col).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    start = F.col("_chunk") * COPIES_PER_TASK
    stop = F.least(F.col("_n"), start + COPIES_PER_TASK) - 1
    numbered = (
        chunks.repartition(digest_col, "_chunk")
        .withColumn("copy_no", F.explode(F.sequence(start, stop)))
        .select(*columns, digest_col, "copy_no")
    )
    return single.union(numbered)


def records_from_table(
    rows: DataFrame, source_dataset: str | Column, key_col: str | None = None, min_chars: int = MIN_BODY_CHARS
) -> DataFrame:
    """Records from (source_path, text, label, subject, sender[, key]) rows.

    The id uses the source's own key where there is one; otherwise path, content hash and a
    number among equal rows, since rows of a distributed table have no stable position.
    """
    named = source_dataset if isinstance(source_dataset, Column) else F.lit(source_dataset)
    clean = rows.withColumns(
        {
            "label": label_of(F.col("label")),
            "clean_text": X.clean_text(F.col("text")),
            "subject": X.clean_text(F.col("subject")),
            "sender": X.clean_text(F.col("sender")),
        }
    ).filter(F.col("label").isNotNull() & long_enough(F.col("clean_text"), min_chars))
    if key_col is None:
        clean = number_copies(clean)
        email_id = record_id(F.col("source_path"), F.col("_digest"), F.col("copy_no"), sep=":")
    else:
        email_id = record_id(F.col("source_path"), F.col(key_col), id_prefix(F.col("clean_text")), sep=":")
    full = clean.withColumns(
        {
            "email_id": email_id,
            "source_dataset": named,
            "date": F.lit(""),
            "raw_text": F.col("clean_text"),
            "has_html": F.lit(False),
            "attachment_hint": F.lit(False),
            "is_corrupted": F.lit(False),
        }
    )
    return finish_record(full.withColumn("message_id", F.col("email_id")))


def records_from_mail(parsed: DataFrame, source_dataset: str, sender_by_path: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) from parsed messages that carry ``path`` and ``label``.

    Unparsed messages go to the rejects with their error instead of vanishing.
    """
    rejects = parsed.filter(F.col("parse_error").isNotNull()).select("path", "parse_error")
    sound = parsed.filter(
        F.col("parse_error").isNull() & (F.col("label") != -1) & long_enough(F.col("clean_text"))
    )
    if sender_by_path:
        sound = sound.withColumn(
            "sender", F.when(F.col("sender") == "", sender_from_path(F.col("path"))).otherwise(F.col("sender"))
        )
    full = sound.withColumns(
        {
            "email_id": record_id(F.col("path"), F.col("message_id"), id_prefix(F.col("clean_text")), sep="::"),
            "source_dataset": F.lit(source_dataset),
            "is_corrupted": F.lit(False),
        }
    )
    return finish_record(full), rejects


def corrupted_records(parsed: DataFrame, source_dataset: str) -> DataFrame:
    """Records of the messages that could not be parsed: no text, ``is_corrupted`` set, the digest as their id.

    They go through the dataset stages with the others, so that the funnel counts them before the
    filter takes them out. Messages without a label by folder are left out, as among the sound ones.
    """
    bad = parsed.filter(F.col("parse_error").isNotNull() & (F.col("label") != -1))
    return finish_record(bad.withColumns({
        "email_id": record_id(F.col("path"), F.col("message_id"), F.lit(""), sep="::"),
        "source_dataset": F.lit(source_dataset), "is_corrupted": F.lit(True),
    }))


def union_corpora(*corpora: DataFrame | None) -> DataFrame:
    """All corpora as one table; an error when there is nothing in any of them."""
    present = [c for c in corpora if c is not None]
    union = reduce(DataFrame.unionByName, present) if present else None
    if union is None or union.isEmpty():
        raise ValueError("No records parsed: check the corpus paths and layouts.")
    return union
