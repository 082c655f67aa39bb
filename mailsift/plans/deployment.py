"""The deployed path as one staged job: fit, calibrate on held-out mail, choose, save, reload, gate.

Every stage that a later one reads is written below ``out``: bundles, scores of the test split, gates.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from mailsift.config import SEED, Settings
from mailsift.functions.text import hash32
from mailsift.operators import audit, metrics as M, scoring as S, thresholds as T
from mailsift.plans.training import Calibrated, TrainedModels, calibrate_models, train_models
from mailsift.session import side_by_side, written


@dataclass
class Deployment:
    """Where the bundles are, and what the reloaded ones say of the test split."""

    paths: dict[str, str]
    calibrated: Calibrated
    scores: DataFrame  # model, email_id, label, raw, probability, pred, risk_code
    gates: DataFrame  # model, check, level, value


def halves(df: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Two halves by a hash of the id: the first to fit a calibrator on, the second to judge it by."""
    first = F.pmod(hash32(f"calibration-{seed}", F.col("email_id")), F.lit(2)) == 0
    return df.filter(first), df.filter(~first)


def deploy(train: DataFrame, valid: DataFrame, test: DataFrame, out: str, settings: Settings = Settings(), version: int = 1) -> Deployment:
    """Logistic regression with a temperature and the SVM with a sigmoid, taken to the test split.

    The calibrators are fitted on one half of ``valid``; the other half judges them and gives each
    model its threshold under ``settings.precision_floor``. Bundles are saved with their threshold and
    version, loaded again, and only the loaded ones score ``test``. The gates compare the test split
    before and after calibration, and report its metrics at the threshold.
    """
    trained = train_models(train, valid)
    fit_on, judged = halves(trained.predictions, settings.seed)
    calibrated = calibrate_models(TrainedModels(trained.bundles, judged, trained.summary), fit_on)
    after = calibrated.scores.select("model", "label", F.col("prob_after").alias("probability"))
    sweep = written(T.threshold_sweep(after, ("model",)), "sweep")
    chosen = written(T.choose_threshold(sweep, ("model",), settings.precision_floor), "chosen")
    thresholds = {row.model: row.threshold for row in chosen.collect()}  # a row per model
    paths = {name: f"{out}/models/{name}/v{version}" for name in calibrated.bundles}

    def reloaded(name: str) -> DataFrame:
        bundle = calibrated.bundles[name]
        bundle.threshold, bundle.version = thresholds[name], version
        bundle.save(paths[name])
        return S.MailModel.load(paths[name]).score(test.select("email_id", "label", "clean_text"), keep_raw=True).withColumn("model", F.lit(name))

    parts = side_by_side(reloaded, paths)
    columns = ("model", "email_id", "label", "raw", "probability", "pred", "risk_code")
    reduce(DataFrame.unionByName, parts).select(*columns).write.mode("overwrite").parquet(f"{out}/scores")
    scores = test.sparkSession.read.parquet(f"{out}/scores")

    def checked(name: str) -> DataFrame:
        own = scores.filter(F.col("model") == name)
        at, before, after = side_by_side(lambda of: M.report(own, of[0], prob=of[1]), [(thresholds[name], "probability"), (0.5, "raw"), (0.5, "probability")])
        checks = audit.threshold_checks(
            sweep.filter(F.col("model") == name), chosen.filter(F.col("model") == name), at, settings.precision_floor
        ).union(audit.calibration_checks(before, after))
        return checks.select(F.lit(name).alias("model"), "*")

    gates = side_by_side(checked, thresholds)
    reduce(DataFrame.unionByName, gates).write.mode("overwrite").parquet(f"{out}/gates")
    return Deployment(paths, calibrated, scores, test.sparkSession.read.parquet(f"{out}/gates"))
