"""Numeric helpers shared by reports and the training jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den) -> Column:
    """SAFE_DIVIDE: NULL on a zero or NULL denominator instead of an error."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num, den, digits: int = 2) -> Column:
    return F.round(safe_ratio(num, den) * 100, digits)


def sigmoid(z) -> Column:
    """Logistic function with the logit clipped to +-500 (no overflow)."""
    zc = F.least(F.greatest(_c(z), F.lit(-500.0)), F.lit(500.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-zc))


def truncate_1dp(x) -> Column:
    """Cut (not round) to one decimal, computed in DECIMAL so a double sitting
    just under the decimal does not floor one step low."""
    d = _c(x).cast("decimal(38,10)")
    return (F.floor(d * 10) / 10).cast("decimal(20,1)").cast("double")


def dot(weights, features: list) -> Column:
    """sum_i w[i] * x_i with ``weights`` an array column and ``features`` columns."""
    terms = [F.get(_c(weights), i) * _c(f) for i, f in enumerate(features)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out
