"""Logistic scores, decisions and loss terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidalfed import settings as S
from tidalfed.functions.vectors import dot


def linear_score(features: Sequence[Column], weights: Column, bias: Column) -> Column:
    return dot(features, weights) + bias


def sigmoid(z: Column, clip: float = S.SIGMOID_CLIP) -> Column:
    """Logistic function; the score is clipped so that ``exp`` stays finite.

    Null without a score: ``greatest`` and ``least`` alone would skip the null.
    """
    bounded = F.greatest(F.lit(-clip), F.least(F.lit(clip), z))
    return F.when(z.isNotNull(), F.lit(1.0) / (F.lit(1.0) + F.exp(-bounded)))


def probability(features: Sequence[Column], weights: Column, bias: Column) -> Column:
    return sigmoid(linear_score(features, weights, bias))


def predicted_class(p: Column, threshold: float = S.DETECTION_THRESHOLD) -> Column:
    """Class 1 from the threshold on (inclusive)."""
    return (p >= F.lit(threshold)).cast("int")


def is_anomaly(p: Column, threshold: float = S.DETECTION_THRESHOLD) -> Column:
    """True above the threshold (strict); false where there is no model."""
    return F.coalesce(p > F.lit(threshold), F.lit(False))


def cross_entropy(p: Column, label: Column, epsilon: float = S.LOSS_EPSILON) -> Column:
    """Loss of one row; its average is the loss of a batch."""
    q = F.greatest(F.lit(epsilon), F.least(F.lit(1.0 - epsilon), p))
    loss = -(label * F.ln(q) + (F.lit(1) - label) * F.ln(F.lit(1.0) - q))
    return F.when(p.isNotNull(), loss)
