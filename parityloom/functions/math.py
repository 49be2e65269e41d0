"""Tail probabilities that Spark has no function for, as vectorised UDFs and plain functions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Z by confidence, and the coefficients of the normal tail.
Z = {0.90: 1.645, 0.95: 1.96, 0.99: 2.576}
TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def gamma_upper(a: float, x: float, eps: float = 1e-12, rounds: int = 500) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0 or a <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        for n in range(1, rounds):
            term *= x / (a + n)
            total += term
            if term < total * eps:
                break
        return max(0.0, 1.0 - front * total)
    # the continued fraction, from its tail to its head
    fraction = 0.0
    for n in range(rounds, 0, -1):
        fraction = n * (n - a) / (x + 2 * n + 1 - a - fraction)
    return front / (x + 1 - a - fraction)


def chi2_sf(statistic: float, df: float) -> float:
    return 1.0 if df <= 0 else gamma_upper(df / 2, statistic / 2)


@F.pandas_udf(DoubleType())
def chi2_p(statistic: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) or pd.isna(d) else chi2_sf(s, d) for s, d in zip(statistic, df, strict=True)], dtype="float64")


def normal_sf(z: Column) -> Column:
    """Upper tail of the standard normal law by the five-term polynomial; 0 beyond 6."""
    size = F.abs(z)
    t = 1 / (1 + 0.2316419 * size)
    poly = F.lit(0.0)
    for c in reversed(TAIL):
        poly = t * (poly + c)
    tail = F.exp(-size * size / 2) / math.sqrt(2 * math.pi) * poly
    tail = F.when(size > 6, 0.0).otherwise(tail)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def normal_bins(mean: float, std: float, low: float, high: float, bins: int) -> np.ndarray:
    """Shares of equal bins under a normal law, normalised to 1."""
    cdf = [0.5 * (1 + math.erf((x - mean) / (std * math.sqrt(2)))) for x in np.linspace(low, high, bins + 1)]
    share = np.diff(cdf)
    return share / share.sum()


def adaptive_tolerance(n: Column, confidence: float = 0.95) -> Column:
    """z * 0.5 / sqrt(n)."""
    return Z.get(confidence, 1.96) * 0.5 / F.sqrt(n)


# Base thresholds by profile.
JS_BASE = {"HIGH_STAKES": 0.03, "NARRATIVE_REQUIRED": 0.04, "ANALYSIS_ONLY": 0.06}


def js_threshold(n: Column, profile: str, critical: str = "", estimated: bool = False) -> Column:
    """Base by profile, times .8 for super-critical or .9 for critical fields, 1.5 if estimated; twice the tolerance at least."""
    base = JS_BASE[profile] * {"super": 0.8, "critical": 0.9}.get(critical, 1.0) * (1.5 if estimated else 1.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(base), 2 * adaptive_tolerance(n)))
