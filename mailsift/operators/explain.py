"""Error analysis: join scores to mail, name each error, list cases and coefficients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailsift.config import DEPLOYED_THRESHOLD, TOP_COEFFICIENTS, TOP_ERRORS
from mailsift.functions import patterns as P
from mailsift.functions.text import contains_any, no_null, word_total

CASE_COLUMNS = (
    "email_id", "label", "pred_label", "probability", "error_type", "subject", "clean_text", "source_dataset", "sender",
)


def join_predictions(calibrated: DataFrame, mail: DataFrame, threshold: float = DEPLOYED_THRESHOLD) -> DataFrame:
    """Calibrated scores left-joined to their mail, with the decision at ``threshold``.

    A score without mail keeps null text; its missing HTML flag counts as false.
    """
    wanted = mail.select("email_id", "subject", "clean_text", "has_html", "source_dataset", "sender")
    joined = calibrated.withColumnsRenamed({"y_true": "label", "prob_after": "probability"}).join(wanted, "email_id", "left")
    return joined.withColumns(
        {
            "has_html": F.coalesce(F.col("has_html").cast("boolean"), F.lit(False)),
            "pred_label": (F.col("probability") >= threshold).cast("int"),
        }
    )


def error_code(label: Column, predicted: Column, subject: Column, body: Column, has_html: Column) -> Column:
    """Stable English code of the error, by an ordered list of rules."""
    text = F.lower(F.concat(no_null(subject), F.lit(" "), no_null(body)))
    html = F.coalesce(has_html.cast("boolean"), F.lit(False))
    words = word_total(text)
    false_positive = (
        F.when(contains_any(text, P.MARKETING_WORDS), "fp_marketing")
        .when(contains_any(text, P.SYSTEM_WORDS), "fp_system")
        .when(html, "fp_marketing")
        .when(words < 8, "short_text")
        .otherwise("fp_system")
    )
    false_negative = (
        F.when(html, "fn_html")
        .when(contains_any(text, P.PHISHING_WORDS), "fn_phishing")
        .when(F.rlike(text, F.lit(P.DIGIT)) & (words < 10), "fn_plain")
        .when(contains_any(text, P.MISSPELT_WORDS), "fn_misspelt")
        .otherwise("short_text")
    )
    return (
        F.when((label == 0) & (predicted == 1), false_positive)
        .when((label == 1) & (predicted == 0), false_negative)
        .otherwise("correct")
    )


def error_label(code: Column) -> Column:
    """The published name of an error code."""
    out = F.lit(None).cast("string")
    for key, text in P.ERROR_TYPES.items():
        out = F.when(code == key, F.lit(text)).otherwise(out)
    return out


def misclassified(joined: DataFrame) -> DataFrame:
    """Wrong rows with ``error_code`` and ``error_type``; no errors give no rows."""
    code = error_code(*[F.col(c) for c in ("label", "pred_label", "subject", "clean_text", "has_html")])
    wrong = joined.filter(F.col("label") != F.col("pred_label")).withColumn("error_code", code)
    return wrong.withColumn("error_type", error_label(F.col("error_code")))


def typical_errors(errors: DataFrame, rows: int = TOP_ERRORS) -> DataFrame:
    return errors.orderBy(F.col("probability").desc(), "email_id").limit(rows).select(*CASE_COLUMNS)


def error_summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error_type").agg(F.count("*").alias("count"))


def error_log(errors: DataFrame, model: str, threshold: float = DEPLOYED_THRESHOLD) -> DataFrame:
    return errors.agg(F.count("*").alias("errors")).select(
        F.lit(model).alias("model"), "errors", F.lit(float(threshold)).alias("threshold")
    )


def top_coefficients(coefficients: DataFrame, rows: int = TOP_COEFFICIENTS) -> DataFrame:
    """The strongest features of either sign with their direction."""
    spam = coefficients.orderBy(F.col("weight").desc(), "feature").limit(rows).withColumn("direction", F.lit("spam_positive"))
    ham = coefficients.orderBy(F.col("weight").asc(), "feature").limit(rows).withColumn("direction", F.lit("ham_negative"))
    return spam.unionByName(ham)
