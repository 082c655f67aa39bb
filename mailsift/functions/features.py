"""The 20 structured text features as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailsift.functions import patterns as P
from mailsift.functions.text import contains_any, no_null

FEATURE_NAMES = (
    "char_len", "word_count", "sentence_count", "exclamation_count", "question_count",
    "upper_ratio", "digit_ratio", "url_count", "email_count", "html_tag_count",
    "has_html", "attachment_hint", "unsubscribe_count", "money_symbol_count",
    "phone_pattern_count", "punctuation_density", "spam_keyword_count",
    "promo_keyword_count", "too_many_links", "repeated_char_flag",
)


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _chars_in(text: Column, char_class: str) -> Column:
    """Characters of one class, by length difference: no array of matches is built."""
    return F.length(text) - F.length(F.regexp_replace(text, char_class + "+", ""))


def _literal(text: Column, word: str) -> Column:
    """Occurrences of an ASCII word, from byte lengths, which are known without a scan."""
    gone = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(word), F.lit("")))
    return gone if len(word) == 1 else (gone / len(word)).cast("int")


def _words(lower: Column, words: tuple[str, ...]) -> Column:
    total = F.lit(0)
    for word in words:  # most texts lack most words, and a test is cheaper than a replacement
        total = total + _if_has(lower.contains(word), _literal(lower, word))
    return total


def _if_has(condition: Column, count: Column) -> Column:
    return F.when(condition, count).otherwise(F.lit(0))


def structured_feature_columns(text: Column) -> dict[str, Column]:
    text = no_null(text)
    lower = F.lower(text)
    chars = F.length(text)
    per_char = F.greatest(F.lit(1), chars)
    # Beyond the last ">" no tag can end, and every "<" there would search to the end of the text.
    closed = F.left(text, chars - F.length(F.substring_index(text, ">", -1)))
    tags = _if_has(text.contains("<"), _matches(closed, P.HTML_TAG))
    links = _matches(text, "(?iu)(?=[hw])(?:" + P.URL + ")")
    columns = {
        "char_len": chars,
        "word_count": _matches(text, P.WORD + "+"),
        "sentence_count": F.greatest(F.lit(1), _matches(text, P.SENTENCE_END)),
        "exclamation_count": _literal(text, "!"),
        "question_count": _literal(text, "?"),
        "upper_ratio": _chars_in(text, P.UPPER) / F.greatest(F.lit(1), _chars_in(text, P.ALPHA)),
        "digit_ratio": _chars_in(text, P.DIGIT) / per_char,
        "url_count": links,
        "email_count": _if_has(text.contains("@"), _matches(text, P.EMAIL_AT_RUN)),
        "html_tag_count": tags,
        "has_html": (lower.contains("<html") | lower.contains("<body") | (tags > 0)).cast("int"),
        "attachment_hint": contains_any(lower, P.ATTACHMENT_WORDS).cast("int"),
        "unsubscribe_count": _words(lower, P.UNSUBSCRIBE_PHRASES),
        "money_symbol_count": _literal(text, "$"),
        "phone_pattern_count": _matches(text, r"(?=[+(\p{Nd}])" + P.PHONE),
        "punctuation_density": _chars_in(text, P.PUNCTUATION) / per_char,
        "spam_keyword_count": _words(lower, P.SPAM_WORDS),
        "promo_keyword_count": _words(lower, P.PROMO_WORDS),
        "too_many_links": (links >= 3).cast("int"),
        "repeated_char_flag": F.rlike(text, F.lit(P.REPEATED_CHAR)).cast("int"),
    }
    return {name: columns[name] for name in FEATURE_NAMES}


def structured_features(df: DataFrame, text_col: str = "clean_text", keep: tuple[str, ...] = ("email_id",)) -> DataFrame:
    """``keep`` columns plus the 20 features; rows are never matched by position."""
    columns = structured_feature_columns(F.col(text_col))
    return df.select(*keep, *[column.alias(name) for name, column in columns.items()])
