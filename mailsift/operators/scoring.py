"""Deployed model: text features, classifier and calibrator; batch scoring and history."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailsift.config import DEPLOYED_THRESHOLD, HISTORY_ROWS
from mailsift.functions.probability import apply_sigmoid, apply_temperature, risk_code, risk_label
from mailsift.functions.text import no_null, preview
from mailsift.operators.linear import SCORERS, BayesScorer, LogisticScorer, SvmScorer
from mailsift.sources.mail_files import parse_mail
from mailsift.sources.tables import SCORING_ROLES, quoted

Scorer = LogisticScorer | BayesScorer | SvmScorer
MODE_TEXT, MODE_FILE, MODE_BATCH = "text", "eml", "csv_batch"


@dataclass
class MailModel:
    """Vectoriser, classifier and calibrator, saved and loaded as one folder."""

    features: PipelineModel
    scorer: Scorer
    calibrator: dict = field(default_factory=dict)  # {} | {"temperature": t} | {"slope": a, "intercept": b}
    text_col: str = "clean_text"
    threshold: float = DEPLOYED_THRESHOLD
    version: int = 0

    def calibrate(self, prob: Column) -> Column:
        if "temperature" in self.calibrator:
            return apply_temperature(prob, self.calibrator["temperature"])
        if "slope" in self.calibrator:
            return apply_sigmoid(prob, self.calibrator["slope"], self.calibrator["intercept"])
        return prob

    def raw_scores(self, df: DataFrame, out: str = "probability") -> DataFrame:
        vectors = self.features.transform(df.withColumn(self.text_col, no_null(F.col(self.text_col))))
        return self.scorer.score(vectors, out).drop("features")

    def score(self, df: DataFrame, threshold: float | None = None, keep_raw: bool = False) -> DataFrame:
        """``df`` with probability, pred, risk and risk_code; stateless and map-only.

        The decision uses ``threshold``, the bundle's own by default, and the risk its own cuts, so a
        mail can be of risk ``spam`` and still not be flagged. ``keep_raw`` adds the score before
        calibration as ``raw``.
        """
        scored = self.raw_scores(df, "raw").withColumn("probability", self.calibrate(F.col("raw")))
        scored = scored if keep_raw else scored.drop("raw")
        p, threshold = F.col("probability"), self.threshold if threshold is None else threshold
        return scored.withColumns(
            {"pred": (p >= threshold).cast("int"), "risk": risk_label(p), "risk_code": risk_code(p)}
        )

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.features.write().overwrite().save(path + "/features")
        facts = {
            **self.scorer.save(path), "calibrator": self.calibrator, "text_col": self.text_col, "threshold": self.threshold, "version": self.version,
        }
        spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.mode("overwrite").text(path + "/facts")

    @staticmethod
    def load(path: str) -> "MailModel":
        facts = json.loads(SparkSession.active().read.text(path + "/facts").first()[0])
        scorer = SCORERS[facts["kind"]].load(path, facts)
        return MailModel(
            PipelineModel.load(path + "/features"), scorer, facts["calibrator"], facts["text_col"], facts["threshold"], facts["version"],
        )


def predictions(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(email_id, label, source_dataset, probability, pred_label)."""
    return scored.select(
        "email_id", "label", "source_dataset", "probability", (F.col("probability") >= threshold).cast("int").alias("pred_label")
    )


def scoring_column(columns: list[str]) -> str | None:
    """The first column that holds mail text."""
    return next((c for c in columns if c.lower() in SCORING_ROLES), None)


def score_table(table: DataFrame, model: MailModel) -> DataFrame | None:
    """Every row of a table with ``probability`` and ``risk``; None without a text column."""
    column = scoring_column(table.columns)
    if column is None:
        return None
    kept = [c for c in table.columns if c not in ("probability", "risk")]
    named = table.select(*map(quoted, kept), no_null(quoted(column).cast("string")).alias("_text"))
    source = named.withColumn("_original", F.struct(*map(quoted, kept))).select(
        "_original", F.col("_text").alias(model.text_col)
    )
    return model.score(source).select("_original.*", "probability", "risk")


def score_mail(files: DataFrame, model: MailModel) -> DataFrame:
    """Raw messages parsed and scored, a row for each; unparsed ones have null scores and their ``parse_error``."""
    scored = model.score(parse_mail(files))
    parsed = F.col("parse_error").isNull()
    return scored.withColumns({c: F.when(parsed, F.col(c)) for c in ("probability", "pred", "risk", "risk_code")})


def batch_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg("probability").alias("mean_probability"), F.count("*").alias("rows"))


def history_entries(scored: DataFrame, ts: Column, mode: str, text_col: str = "clean_text") -> DataFrame:
    """One log row per scored mail; the caller supplies the time."""
    return scored.select(
        ts.alias("ts"), F.lit(mode).alias("mode"), "probability", "risk", preview(F.col(text_col)).alias("text_preview")
    )


def batch_history_entry(summary: DataFrame, ts: Column) -> DataFrame:
    """One log row per scored table: the mean score and the number of rows."""
    return summary.select(
        ts.alias("ts"), F.lit(MODE_BATCH).alias("mode"), F.col("mean_probability").alias("probability"),
        F.lit("batch").alias("risk"), F.concat(F.lit("rows="), F.col("rows").cast("string")).alias("text_preview"),
    )


def append_history(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def recent_history(history: DataFrame, rows: int = HISTORY_ROWS, tie: str = "text_preview") -> DataFrame:
    """The newest ``rows`` entries: a top-k, never a full sort."""
    return history.orderBy(F.col("ts").desc(), tie).limit(rows)
