"""Text functions and features: stated values for awkward strings, and time in proportion to length."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from mailsift.functions import patterns as P, text as X
from mailsift.functions.features import structured_features

# text -> (clean, for dedup, as a subject, white-space words, latin tokens)
TEXTS = {
    "": ("", "", "", 0, []),
    " \x00\n\x1c ": ("", "", "\x00", 1, []),
    "Re: Fwd :  Plan\xa0B": ("Re: Fwd : Plan B", "re: fwd : plan b", "fwd : plan b", 5, ["re", "fwd", "plan", "b"]),
    " FW:x": ("FW:x", "fw:x", "x", 1, ["fw", "x"]),
    "re\x85:\x0bÉté": ("re : Été", "re : été", "été", 3, ["re", "t"]),
    "Go to HTTPS://A.b/c?d=1 or www.x.y now": ("Go to HTTPS://A.b/c?d=1 or www.x.y now", "go to <url> or <url> now", "go to https://a.b/c?d=1 or www.x.y now", 6,
                                               ["go", "to", "https", "a", "b", "c", "d", "or", "www", "x", "y", "now"]),
    "a.b-c@d.e, x@y @z.w q@r.s-@t.u": ("a.b-c@d.e, x@y @z.w q@r.s-@t.u", "<email>, x@y @z.w <email><email>", "a.b-c@d.e, x@y @z.w q@r.s-@t.u", 4,
                                       ["a", "b", "c", "d", "e", "x", "y", "z", "w", "q", "r", "s", "t", "u"]),
    "m@n.o.p 12 ٣ ² it's": ("m@n.o.p 12 ٣ ² it's", "<email> <num> <num> ² it's", "m@n.o.p 12 ٣ ² it's", 5, ["m", "n", "o", "p", "it's"]),
    "日本　 語": ("日本 語", "日本 語", "日本 語", 2, []),
}

# text -> the features that are not zero; sentence_count is at least 1 and stated where it is more
FEATURES = {
    "": {},
    "Free!!!! Really? Yes.": {"char_len": 21, "word_count": 3, "sentence_count": 3, "exclamation_count": 4, "question_count": 1, "upper_ratio": 3 / 13,
                              "punctuation_density": 6 / 21, "spam_keyword_count": 1, "promo_keyword_count": 1, "repeated_char_flag": 1},
    "winner ²3 ①": {"char_len": 11, "word_count": 3, "digit_ratio": 3 / 11, "spam_keyword_count": 2, "promo_keyword_count": 2},
    "http://a.b https://c www.d": {"char_len": 26, "word_count": 7, "sentence_count": 2, "url_count": 3, "punctuation_density": 4 / 26, "too_many_links": 1},
    "a@b.c-@d.e f@g": {"char_len": 14, "word_count": 7, "sentence_count": 2, "email_count": 2, "punctuation_density": 3 / 14},
    "<b>x</b> <> < <": {"char_len": 15, "word_count": 3, "html_tag_count": 2, "has_html": 1},
    "<a<b>c>d<e": {"char_len": 10, "word_count": 5, "html_tag_count": 1, "has_html": 1},
    "< BODY no end <body": {"char_len": 19, "word_count": 4, "upper_ratio": 4 / 13, "has_html": 1},
    "attach $9 $ Unsubscribe, remove": {"char_len": 31, "word_count": 4, "upper_ratio": 1 / 23, "digit_ratio": 1 / 31, "attachment_hint": 1, "unsubscribe_count": 2,
                                        "money_symbol_count": 2, "punctuation_density": 1 / 31},
    "call +1 (415) 555 2671 or 555-1234": {"char_len": 34, "word_count": 8, "digit_ratio": 18 / 34, "phone_pattern_count": 2, "punctuation_density": 3 / 34},
}


def test_text_functions(spark):
    t = F.col("t")
    rows = spark.createDataFrame([(s,) for s in TEXTS], "t string").select(
        "t", X.clean_text(t).alias("c"), X.normalize_for_dedup(t).alias("d"), X.normalize_subject(t).alias("s"),
        X.body_hash(t).alias("h"), X.word_total(t).alias("w"), X.latin_tokens(t).alias("k"),
    ).collect()
    assert {r.t: (r.c, r.d, r.s, r.w, r.k) for r in rows} == TEXTS
    assert all(r.h == hashlib.sha256(TEXTS[r.t][1].encode()).hexdigest() for r in rows)


def test_features(spark):
    rows = structured_features(spark.createDataFrame([(s, s) for s in FEATURES], "email_id string, clean_text string")).collect()
    wrong = {}
    for r in rows:
        found = {k: v for k, v in r.asDict().items() if k != "email_id" and v and not (k == "sentence_count" and v == 1)}
        if found != pytest.approx(FEATURES[r.email_id]):
            wrong[r.email_id] = found
    assert not wrong


def test_linear_patterns_find_what_the_plain_ones_find(spark):
    rng = random.Random(7)
    strings = ["".join(rng.choice("ab@@..-<<>> é9") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    t = F.col("clean_text")
    frame = spark.createDataFrame([(s, s) for s in strings], "email_id string, clean_text string")
    both = structured_features(frame, keep=("email_id", "clean_text")).select(
        "email_count", "html_tag_count", F.regexp_count(t, F.lit(P.EMAIL)).alias("e"), F.regexp_count(t, F.lit(P.HTML_TAG)).alias("h"),
        F.regexp_replace(t, P.EMAIL, "#").alias("plain"), F.regexp_replace(t, P.EMAIL_AT_RUN, "#").alias("anchored"),
    ).collect()
    assert all(r.email_count == r.e and r.html_tag_count == r.h and r.plain == r.anchored for r in both)
    assert any(r.e > 1 for r in both) and any(r.h > 1 for r in both)


@pytest.mark.parametrize("text", ["a" * 1_000_000 + " @", "<" * 1_000_000, "x@" + "b" * 1_000_000, "y" + " " * 1_000_000 + "z", "a.-" * 300_000 + "@<"])
def test_long_runs_take_time_in_proportion(spark, text):
    frame = spark.createDataFrame([(text, text)], "email_id string, clean_text string").select(
        X.normalize_for_dedup(F.col("clean_text")).alias("d"), X.strip(F.col("clean_text")).alias("s"), "email_id", "clean_text"
    ).cache()
    frame.count()
    start = time.perf_counter()
    frame.select(F.length("d"), F.length("s")).collect()
    structured_features(frame).select("email_count", "html_tag_count", "has_html").collect()
    assert time.perf_counter() - start < 5
