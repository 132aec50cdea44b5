"""Logarithms of normal tail probabilities as column expressions, without a Python worker.

The complementary error function is a midpoint sum of ``exp(-t^2) / (x^2 + t^2)`` with step ``STEP``, whose
error is below 1e-15; the pole beside the real line adds ``2 / (1 + exp(2 pi x / STEP))``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = 0.5
POINTS = tuple(((i + 0.5) * STEP) ** 2 for i in range(14))
WEIGHTS = tuple(math.exp(-t) for t in POINTS)
FAR = 6.0  # from here on the pole's part is below the rounding of the sum


def log_erfc(x: Column) -> Column:
    """ln erfc(x) for x >= 0, also where erfc itself would be 0."""
    total = sum((F.lit(w) / (x * x + F.lit(t)) for w, t in zip(WEIGHTS, POINTS)), F.lit(0.0))
    scaled = x * F.lit(2.0 * STEP / math.pi) * total
    near = F.log(scaled * F.exp(-x * x) + F.lit(2.0) / (F.lit(1.0) + F.exp(x * F.lit(2.0 * math.pi / STEP))))
    return F.when(x < FAR, near).otherwise(F.log(scaled) - x * x)


def log_normal_cdf(z: Column) -> Column:
    """ln of the standard normal distribution function."""
    half = log_erfc(F.abs(z) / F.lit(math.sqrt(2.0))) - F.lit(math.log(2.0))
    return F.when(z < 0, half).otherwise(F.log1p(-F.exp(half)))


def log_erfc_sql(x: str) -> str:
    """SQL twin of ``log_erfc``."""
    total = " + ".join(f"{w!r}::DOUBLE / ({x} * {x} + {t!r}::DOUBLE)" for w, t in zip(WEIGHTS, POINTS))
    scaled = f"({x} * {2.0 * STEP / math.pi!r}::DOUBLE * ({total}))"
    pole = f"2 / (1 + exp({x} * {2.0 * math.pi / STEP!r}::DOUBLE))"
    return (
        f"CASE WHEN {x} < {FAR} THEN ln({scaled} * exp(-{x} * {x}) + {pole}) "
        f"ELSE ln({scaled}) - {x} * {x} END"
    )
