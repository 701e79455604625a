"""Metric and density expressions (F3-F8). All are built-in Column expressions
so they stay inside whole-stage codegen; aggregates get partial (map-side)
aggregation for free."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_SQRT_2PI = 0.5 * math.log(2.0 * math.pi)
INV_SQRT_2PI = 1.0 / math.sqrt(2.0 * math.pi)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sse(y, p) -> Column:
    """Sum of squared errors."""
    d = _c(y).cast("double") - _c(p).cast("double")
    return F.sum(d * d)


def rmse(y, p) -> Column:
    """sqrt(mean((y - p)^2)), written as sqrt(SSE / n) so that it shares its
    sum with :func:`r2` (Spark computes equal aggregate expressions once)."""
    d = _c(y).cast("double") - _c(p).cast("double")
    return F.sqrt(sse(y, p) / F.count(d))


def r2(y, p) -> Column:
    """1 - SSE / SST; with SST = 0 it is 1.0 for a perfect fit, else 0.0."""
    yy = _c(y).cast("double")
    sst = F.regr_syy(yy, yy)
    err = sse(y, p)
    return (F.when(sst == 0, F.when(err == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(1.0) - err / F.nullif(sst, F.lit(0.0))))


def normal_logpdf(x, mu, sigma) -> Column:
    """log density of Normal(mu, sigma) at x."""
    z = (_c(x).cast("double") - _c(mu)) / _c(sigma)
    return -F.lit(LOG_SQRT_2PI) - F.log(_c(sigma)) - z * z / 2.0


def normal_pdf(x, mu, sigma) -> Column:
    """density of Normal(mu, sigma) at x."""
    z = (_c(x).cast("double") - _c(mu)) / _c(sigma)
    return F.exp(-z * z / 2.0) * F.lit(INV_SQRT_2PI) / _c(sigma)


def normal_nll(y, mu, sigma) -> Column:
    """mean negative log-likelihood of y under a per-row Normal."""
    return F.avg(-normal_logpdf(y, mu, sigma))


def linspace_point(i, lo, hi, k: int) -> Column:
    """F8: i-th of ``k`` evenly spaced points from lo to hi, both included."""
    lo_c, hi_c = _c(lo).cast("double"), _c(hi).cast("double")
    step = (hi_c - lo_c) / F.lit(float(k - 1))
    return F.when(_c(i) == k - 1, hi_c).otherwise(lo_c + _c(i).cast("double") * step)
