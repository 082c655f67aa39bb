"""Probability expressions: clipping, logits, calibration curves and risk bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mailsift.config import PROB_CLIP, RISK_SAFE_BELOW, RISK_SUSPICIOUS_BELOW
from mailsift.functions.patterns import RISK_LEVELS


def clip(prob: Column) -> Column:
    return F.least(F.greatest(prob, F.lit(PROB_CLIP)), F.lit(1 - PROB_CLIP))


def logit(prob: Column) -> Column:
    p = clip(prob)
    return F.log(p / (F.lit(1.0) - p))


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def apply_sigmoid(prob: Column, slope: Column | float, intercept: Column | float) -> Column:
    slope, intercept = (x if isinstance(x, Column) else F.lit(float(x)) for x in (slope, intercept))
    return sigmoid(slope * logit(prob) + intercept)


def apply_temperature(prob: Column, temperature: Column | float) -> Column:
    temperature = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    return sigmoid(logit(prob) / F.greatest(temperature, F.lit(1e-6)))


def risk_code(prob: Column) -> Column:
    return (
        F.when(prob < RISK_SAFE_BELOW, F.lit("safe"))
        .when(prob < RISK_SUSPICIOUS_BELOW, F.lit("suspicious"))
        .otherwise(F.lit("spam"))
    )


def risk_label(prob: Column) -> Column:
    return (
        F.when(prob < RISK_SAFE_BELOW, F.lit(RISK_LEVELS["safe"]))
        .when(prob < RISK_SUSPICIOUS_BELOW, F.lit(RISK_LEVELS["suspicious"]))
        .otherwise(F.lit(RISK_LEVELS["spam"]))
    )
