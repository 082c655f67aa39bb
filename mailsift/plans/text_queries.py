"""Text functions and structured features over every document and page."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift.functions import patterns as P, text as X
from mailsift.functions.features import structured_features
from mailsift.plans.inputs import NWS, WS, emails, sql_clean, with_views
from mailsift.plans.registry import query, rounded, s6, table

# ---- the text functions in SQL -----------------------------------------------------------


def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def sql_subject(e: str) -> str:
    bare = f"regexp_replace(lower({sql_strip(e)}), '^(?:re|fw|fwd){WS}*:{WS}*', '')"
    return f"regexp_replace({bare}, '{WS}+', ' ', 'g')"


def sql_dedup(e: str) -> str:
    out = f"lower({sql_clean(e)})"
    out = f"regexp_replace({out}, 'https?://{NWS}+|www\\.{NWS}+', '<url>', 'g')"
    out = f"regexp_replace({out}, '[\\p{{L}}\\p{{N}}_.\\-]+@[\\p{{L}}\\p{{N}}_.\\-]+\\.[\\p{{L}}\\p{{N}}_]+', '<email>', 'g')"
    return f"regexp_replace({out}, '\\p{{Nd}}+', '<num>', 'g')"


def sql_body_hash(e: str) -> str:
    return f"sha256({sql_dedup(e)})"


def sql_thread(subject: str, sender: str, body_hash: str) -> str:
    return f"sha256({sql_subject(subject)} || '|' || {sql_strip(f'lower({sender})')} || '|' || {body_hash})"


def sql_sender_group(e: str) -> str:
    return f"sha256(coalesce(nullif({sql_strip(f'lower({e})')}, ''), 'unknown_sender'))"


@query(with_views("emails", f"""SELECT email_id, clean_text, {sql_subject('subject')} AS subject_norm,
  regexp_replace(lower({sql_strip('sender')}), '{WS}+', ' ', 'g') AS sender_norm,
  substr(clean_text, 1, 120) AS preview, {sql_dedup('clean_text')} AS dedup_text FROM emails"""))
def clean_and_normalise(spark, sf_dir):
    """Cleaned text, normalised subject and sender, deduplication text and preview."""
    clean = F.col("clean_text")
    return emails(spark, sf_dir).select(
        "email_id", "clean_text", X.normalize_subject(F.col("subject")).alias("subject_norm"),
        X.normalize_sender(F.col("sender")).alias("sender_norm"), X.preview(clean).alias("preview"),
        X.normalize_for_dedup(clean).alias("dedup_text"),
    )


@query(with_views("emails", f"""SELECT email_id, {sql_body_hash('clean_text')} AS body_group,
  {sql_thread('subject', 'sender', sql_body_hash('clean_text'))} AS thread_group,
  {sql_sender_group('sender')} AS sender_group, sha256({sql_subject('subject')}) AS subject_group,
  sha256(clean_text) AS text_sha, md5(clean_text) AS text_md5 FROM emails"""))
def group_hashes(spark, sf_dir):
    """Body, thread, sender and subject group keys and the content digests."""
    clean = F.col("clean_text")
    return emails(spark, sf_dir).select(
        "email_id", "subject", "sender", X.body_hash(clean).alias("body_group"),
        X.sha256_text(clean).alias("text_sha"), X.md5_text(clean).alias("text_md5"),
    ).select(
        "email_id", "body_group",
        X.thread_group(F.col("subject"), F.col("sender"), F.col("body_group")).alias("thread_group"),
        X.sender_group(F.col("sender")).alias("sender_group"), X.subject_hash(F.col("subject")).alias("subject_group"),
        "text_sha", "text_md5",
    )


@query(with_views("emails", """SELECT token, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(lower(clean_text), '[A-Za-z'']+')) AS token FROM emails) GROUP BY token"""))
def latin_token_counts(spark, sf_dir):
    """Corpus count of every Latin-letter token."""
    tokens = emails(spark, sf_dir).select(F.explode(X.latin_tokens(F.col("clean_text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def _sql_count(pattern: str, e: str = "t") -> str:
    return f"len(regexp_extract_all({e}, '{pattern}'))"


def _sql_words(words: tuple[str, ...]) -> str:
    return " + ".join(f"(length(lo) - length(replace(lo, '{w}', ''))) // {len(w)}" for w in words)


def sql_features(key: str, text: str, source: str) -> str:
    """The 20 features of ``text`` from ``source``, with ``key``."""
    digit = f"[{P.DIGIT_CHARS}]"
    counts = {
        "char_len": "length(t)",
        "word_count": _sql_count(r"[\p{L}\p{N}_]+"),
        "sentence_count": f"greatest(1, {_sql_count('[.!?]+')})",
        "exclamation_count": _sql_count("!"),
        "question_count": _sql_count(r"\?"),
        "url_count": _sql_count(rf"(?i)https?://{NWS}+|www\.{NWS}+"),
        "email_count": _sql_count(r"[\p{L}\p{N}_.\-]+@[\p{L}\p{N}_.\-]+\.[\p{L}\p{N}_]+"),
        "html_tag_count": _sql_count("<[^>]+>"),
        "attachment_hint": "CASE WHEN contains(lo, 'attach') OR contains(lo, 'file') THEN 1 ELSE 0 END",
        "unsubscribe_count": _sql_words(P.UNSUBSCRIBE_PHRASES),
        "money_symbol_count": _sql_count(r"\$"),
        "phone_pattern_count": _sql_count(
            rf"(?:\+?\p{{Nd}}{{1,3}}[-.\s\x0B\x1c-\x1f\x85\p{{Z}}]?)?(?:\(?\p{{Nd}}{{2,4}}\)?[-.\s\x0B\x1c-\x1f\x85\p{{Z}}]?)?"
            rf"\p{{Nd}}{{3,4}}[-.\s\x0B\x1c-\x1f\x85\p{{Z}}]?\p{{Nd}}{{4}}"
        ),
        "spam_keyword_count": _sql_words(P.SPAM_WORDS),
        "promo_keyword_count": _sql_words(P.PROMO_WORDS),
    }
    columns = ", ".join(f"CAST({sql} AS INTEGER) AS {name}" for name, sql in counts.items())
    ratios = ", ".join([
        f"{s6(_sql_count(chr(92) + 'p{Lu}') + ' / greatest(1, ' + _sql_count(chr(92) + 'p{L}') + ')')} AS upper_ratio",
        f"{s6(_sql_count(digit) + ' / greatest(1, length(t))')} AS digit_ratio",
        f"{s6(_sql_count(P.PUNCTUATION) + ' / greatest(1, length(t))')} AS punctuation_density",
    ])
    return f"""SELECT *, CASE WHEN url_count >= 3 THEN 1 ELSE 0 END AS too_many_links FROM (
  SELECT {key}, {columns}, {ratios},
    CASE WHEN contains(lo, '<html') OR contains(lo, '<body') OR {_sql_count('<[^>]+>')} > 0 THEN 1 ELSE 0 END AS has_html,
    CASE WHEN len(list_filter(range(1, length(t) - 2), lambda i: ch[i] <> chr(10) AND ch[i] = ch[i+1] AND ch[i] = ch[i+2] AND ch[i] = ch[i+3])) > 0
      THEN 1 ELSE 0 END AS repeated_char_flag
  FROM (SELECT {key}, {text} AS t, lower({text}) AS lo, regexp_split_to_array({text}, '') AS ch FROM {source}))"""


def _feature_table(df, text_col: str, key: str):
    return rounded(structured_features(df, text_col, (key,)), "upper_ratio", "digit_ratio", "punctuation_density")


@query(with_views("emails", sql_features("email_id", "clean_text", "emails")))
def mail_features(spark, sf_dir):
    """The 20 structured features of every mail."""
    return _feature_table(emails(spark, sf_dir), "clean_text", "email_id")


@query(sql_features("page_id", "html", "pages"))
def page_features(spark, sf_dir):
    """The 20 structured features of every raw web page."""
    return _feature_table(table(spark, sf_dir, "pages"), "html", "page_id")
