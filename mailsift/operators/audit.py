"""Split, overlap and metric audits as (check, level, value) rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from mailsift.functions import text as X
from mailsift.operators.curate import as_metrics


def split_audit(df: DataFrame, expected_rows: Mapping[str, int], expected_spam: Mapping[str, int]) -> DataFrame:
    """Rows and spam per split against the expected numbers."""
    spark = df.sparkSession
    expected = spark.createDataFrame(
        [(s, int(n), int(expected_spam[s])) for s, n in expected_rows.items()],
        "split string, expected_rows long, expected_spam long",
    )
    actual = df.groupBy("split").agg(F.count("*").alias("rows"), F.sum("label").cast("bigint").alias("spam"))
    joined = F.broadcast(expected).join(actual, "split", "left").fillna(0, ["rows", "spam"])
    return joined.withColumns(
        {
            "rows_level": F.when(F.col("rows") == F.col("expected_rows"), "PASS").otherwise("FAIL"),
            "spam_level": F.when(F.col("spam") == F.col("expected_spam"), "PASS").otherwise("FAIL"),
        }
    )


def _shared(df: DataFrame, key: Column, left: str, right: str) -> DataFrame:
    seen = df.groupBy(key.alias("_key")).agg(
        F.bool_or(F.col("split") == left).alias("in_left"), F.bool_or(F.col("split") == right).alias("in_right")
    )
    return seen.filter(F.col("_key") != "").agg(
        F.count_if(F.col("in_left") & F.col("in_right")).alias("overlap"), F.count_if("in_right").alias("right_keys")
    )


def md5_overlap(df: DataFrame, left: str = "train", right: str = "test") -> DataFrame:
    """Shared content hashes over the number of right *rows*."""
    seen = df.groupBy(X.md5_text(F.col("clean_text")).alias("_key")).agg(
        F.bool_or(F.col("split") == left).alias("in_left"), F.count_if(F.col("split") == right).alias("right_rows")
    )
    return seen.agg(
        F.count_if(F.col("in_left") & (F.col("right_rows") > 0)).alias("overlap"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("right_rows"),
    ).select("overlap", (F.col("overlap") / F.greatest(F.lit(1), F.col("right_rows"))).alias("rate"))


def _key_overlap(df: DataFrame, key: Column, left: str, right: str) -> DataFrame:
    """Shared keys over distinct right keys; the empty key is no key."""
    return _shared(df, key, left, right).select(
        "overlap", (F.col("overlap") / F.greatest(F.lit(1), F.col("right_keys"))).alias("rate")
    )


def sender_overlap(df: DataFrame, left: str = "train", right: str = "test") -> DataFrame:
    return _key_overlap(df, X.normalize_sender(F.col("sender")), left, right)


def subject_overlap(df: DataFrame, left: str = "train", right: str = "test") -> DataFrame:
    return _key_overlap(df, X.normalize_subject(F.col("subject")), left, right)


def except_key(df: DataFrame, key: str, removed: str = "") -> DataFrame:
    """Distinct keys without one key: the set difference."""
    return df.select(key).distinct().filter(F.col(key) != removed)


def overlap_checks(df: DataFrame) -> DataFrame:
    """The three overlap checks; shared content fails, shared senders or subjects warn."""
    parts = []
    for name, table, bad in (
        ("md5_overlap", md5_overlap(df), "FAIL"),
        ("sender_overlap", sender_overlap(df), "WARN"),
        ("subject_overlap", subject_overlap(df), "WARN"),
    ):
        level = F.when(F.col("overlap") == 0, "PASS").otherwise(bad)
        parts.append(table.select(F.lit(name).alias("check"), level.alias("level"), F.col("overlap").cast("double").alias("value")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _check(name: str, passed: Column, value: Column, bad: str = "FAIL") -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.when(passed, "PASS").otherwise(bad).alias("level"),
        value.cast("double").alias("value"),
    )


def threshold_checks(sweep: DataFrame, chosen: DataFrame, test_report: DataFrame, floor: float, grid_rows: int = 91) -> DataFrame:
    """Grid size, chosen threshold and its precision, and the test metrics at it."""
    size = sweep.agg(F.count("*").alias("n")).select(
        F.explode(F.array(_check("grid_rows", F.col("n") == grid_rows, F.col("n")))).alias("c")
    )
    at_valid = chosen.select(
        F.explode(
            F.array(
                _check("selected_threshold", F.col("threshold").between(0.05, 0.95), F.col("threshold")),
                _check("valid_precision", F.col("precision") >= floor, F.col("precision")),
            )
        ).alias("c")
    )
    metrics = ("precision", "recall", "f1", "macro_f1")
    at_test = test_report.select(
        F.explode(F.array(*[_check(f"test_{m}", F.lit(True), F.col(m)) for m in metrics])).alias("c")
    )
    return size.unionByName(at_valid).unionByName(at_test).select("c.*")


def calibration_checks(raw: DataFrame, calibrated: DataFrame) -> DataFrame:
    """ECE must not rise (fail) and the Brier score must not rise (warn).

    ``raw`` and ``calibrated`` are one-row reports with ``ece`` and ``brier``.
    """
    both = (
        raw.select(F.lit("raw").alias("kind"), "ece", "brier")
        .unionByName(calibrated.select(F.lit("cal").alias("kind"), "ece", "brier"))
        .groupBy()
        .agg(*[
            F.max(F.when(F.col("kind") == kind, F.col(m))).alias(f"{kind}_{m}")
            for kind in ("raw", "cal") for m in ("ece", "brier")
        ])
    )
    return both.select(
        F.explode(
            F.array(
                _check("ece", F.col("cal_ece") <= F.col("raw_ece") + 1e-12, F.col("cal_ece") - F.col("raw_ece")),
                _check("brier", F.col("cal_brier") <= F.col("raw_brier") + 1e-12, F.col("cal_brier") - F.col("raw_brier"), "WARN"),
            )
        ).alias("c")
    ).select("c.*")


def split_checks(audit: DataFrame) -> DataFrame:
    """The rows of ``split_audit`` as checks."""
    return audit.select(
        F.explode(
            F.array(
                F.struct(F.concat("split", F.lit("_rows")).alias("check"), F.col("rows_level").alias("level"), F.col("rows").cast("double").alias("value")),
                F.struct(F.concat("split", F.lit("_spam")).alias("check"), F.col("spam_level").alias("level"), F.col("spam").cast("double").alias("value")),
            )
        ).alias("c")
    ).select("c.*")


def quality_rollup(checks: DataFrame) -> DataFrame:
    """Checks per level and whether any failed."""
    return checks.agg(
        *[F.count_if(F.col("level") == level).alias(f"n_{level.lower()}") for level in ("PASS", "WARN", "FAIL")],
        F.coalesce(F.bool_or(F.col("level") == "FAIL"), F.lit(False)).alias("failed"),
    )


__all__ = [
    "as_metrics", "calibration_checks", "except_key", "md5_overlap", "overlap_checks", "quality_rollup",
    "sender_overlap", "split_audit", "split_checks", "subject_overlap", "threshold_checks",
]
