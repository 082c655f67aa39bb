"""Fits and calibrations that do not need each other run at the same time."""

import threading

import pytest

from mailsift.operators import calibration as cal, linear
from mailsift.plans import training


class Met(Exception):
    pass


def _meeting(n):
    """A stand-in that only goes on when ``n`` of its calls are under way."""
    gate = threading.Barrier(n)

    def meet(*args, **kwargs):
        gate.wait(20)
        raise Met

    return meet


def test_imbalance_fits_run_side_by_side(spark, monkeypatch):
    meet = _meeting(4)
    monkeypatch.setattr(training, "_vectors", lambda train, valid: (None, train, valid))
    monkeypatch.setattr(linear, "fit_logistic", meet)
    monkeypatch.setattr(linear.SvmScorer, "fit", meet)
    frame = spark.createDataFrame([("1", 0), ("2", 1)], "email_id string, label int")
    with pytest.raises(Met):
        training.compare_imbalance(frame, frame)


def test_calibrations_run_side_by_side(spark, monkeypatch):
    meet = _meeting(2)
    monkeypatch.setattr(cal, "fit_temperature", meet)
    monkeypatch.setattr(cal, "fit_sigmoid", meet)
    rows = [(name, i % 2, 0.1 + 0.2 * i) for name in training.NAMES.values() for i in range(4)]
    scored = spark.createDataFrame(rows, "model string, label int, probability double")
    with pytest.raises(Met):
        training.calibrate_models(training.TrainedModels({}, scored, scored))
