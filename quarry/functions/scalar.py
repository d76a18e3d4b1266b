"""Scalar activation / scaling expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def sigmoid_grad(a: Column) -> Column:
    """a(1-a), the derivative expressed through the activation."""
    return a * (F.lit(1.0) - a)


def relu(z: Column) -> Column:
    return F.greatest(z, F.lit(0.0))


def softmax(z: Column) -> Column:
    """Softmax of an array, shifted by its largest value."""
    e = F.transform(z, lambda x: F.exp(x - F.array_max(z)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def step(z: Column, threshold: float = 0.0) -> Column:
    """1 when z >= threshold, else 0 (C11)."""
    return F.when(z >= threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def zscore(x: Column, mean: Column, std: Column) -> Column:
    return (x - mean) / std


def unzscore(z: Column, mean: Column, std: Column) -> Column:
    return z * std + mean


def clamp(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))


def scale_score(s: Column) -> Column:
    """40 + 30*s clamped to [20, 100]."""
    return clamp(F.lit(40.0) + F.lit(30.0) * s, 20.0, 100.0)


def round_clamp_int(x: Column, lo: int = 20, hi: int = 100) -> Column:
    """Half-even rounding to an integer, clamped (C14; Python round is half-even)."""
    return F.least(F.greatest(F.bround(x, 0), F.lit(float(lo))), F.lit(float(hi))).cast("int")
