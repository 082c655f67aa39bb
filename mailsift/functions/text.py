"""Text functions, Column -> Column. All run inside whole-stage codegen, none in Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mailsift.config import PREVIEW_CHARS
from mailsift.functions import patterns as P


def no_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def collapse_space(text: Column) -> Column:
    """Every run of white space becomes one plain space."""
    return F.regexp_replace(text, P.UNCLEAN_SPACE_RUN, " ")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, P.EDGE_SPACE, "")


def clean_text(text: Column) -> Column:
    """Null to empty, NUL and white-space runs to one space, edges trimmed."""
    return F.trim(collapse_space(no_null(text)))


def normalize_subject(subject: Column) -> Column:
    """Lower case without *one* leading reply or forward mark."""
    bare = F.regexp_replace(F.lower(strip(no_null(subject))), P.REPLY_PREFIX, "")
    return F.regexp_replace(bare, P.SPACE + "+", " ")


def normalize_for_dedup(text: Column) -> Column:
    """Clean lower text with links, addresses and numbers replaced by marks, in that order.

    The literal test spares the costliest pattern on the many texts that hold no address.
    """
    linked = F.regexp_replace(F.lower(clean_text(text)), P.URL, "<url>")
    addressed = F.when(linked.contains("@"), F.regexp_replace(linked, P.EMAIL_AT_RUN, "<email>")).otherwise(linked)
    return F.regexp_replace(addressed, P.DECIMAL + "+", "<num>")


def sha256_text(text: Column) -> Column:
    return F.sha2(text, 256)


def body_hash(text: Column) -> Column:
    return sha256_text(normalize_for_dedup(text))


def subject_hash(subject: Column) -> Column:
    return sha256_text(normalize_subject(subject))


def thread_group(subject: Column, sender: Column, body_hash_col: Column) -> Column:
    """Group key of subject, sender and body; the message id is left out on purpose."""
    return sha256_text(
        F.concat_ws("|", normalize_subject(subject), strip(F.lower(no_null(sender))), body_hash_col)
    )


def sender_group(sender: Column) -> Column:
    plain = strip(F.lower(no_null(sender)))
    return sha256_text(F.when(plain == "", F.lit("unknown_sender")).otherwise(plain))


def normalize_sender(sender: Column) -> Column:
    return F.regexp_replace(F.lower(strip(no_null(sender))), P.SPACE + "+", " ")


def latin_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(no_null(text)), F.lit(P.LATIN_TOKEN), F.lit(0))


def md5_text(text: Column) -> Column:
    return F.md5(no_null(text))


def preview(text: Column) -> Column:
    return F.substring(text, 1, PREVIEW_CHARS)


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def word_total(text: Column) -> Column:
    """Number of white-space separated words, as ``str.split()`` counts them."""
    return F.regexp_count(text, F.lit(P.NON_SPACE + "+"))


def hash32(seed: int | str, key: Column) -> Column:
    """A seeded uniform 32-bit order key, equal on every engine and every run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("bigint")
