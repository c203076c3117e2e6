"""Special functions missing from Spark SQL, as column expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

_SHIFT = 10  # the asymptotic series are applied at arguments of at least this size


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def digamma(x) -> Column:
    """Logarithmic derivative of the gamma function for x > 0: recurrence up to 10, then the asymptotic series."""
    x = _col(x).cast("double")
    lifted = sum((F.when(x + i < _SHIFT, 1 / (x + i)).otherwise(0.0) for i in range(_SHIFT)), F.lit(0.0))
    y = F.when(x < _SHIFT, x + F.ceil(F.lit(float(_SHIFT)) - x)).otherwise(x)
    q = 1 / (y * y)
    # Bernoulli numbers B_2k / 2k
    series = q * (1 / 12 - q * (1 / 120 - q * (1 / 252 - q * (1 / 240 - q * (5 / 660 - q * (691 / 32760))))))
    return F.log(y) - 0.5 / y - series - lifted


def _bind(value: Column, body) -> Column:
    """``body`` applied to ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lgamma(x) -> Column:
    """Logarithm of the gamma function for x > 0: recurrence up to 10, then the asymptotic series."""

    def series(y):
        q = 1 / (y * y)
        tail = (1 / 12 - q * (1 / 360 - q * (1 / 1260 - q * (1 / 1680 - q * (1 / 1188))))) / y
        return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + tail

    def whole(v):
        # one logarithm of the product of all steps
        product = reduce(lambda p, i: p * F.when(v + i < _SHIFT, v + i).otherwise(1.0), range(_SHIFT), F.lit(1.0))
        y = F.when(v < _SHIFT, v + F.ceil(F.lit(float(_SHIFT)) - v)).otherwise(v)
        return F.when(v < _SHIFT, _bind(y, series) - F.log(product)).otherwise(series(v))

    return _bind(_col(x).cast("double"), whole)


def log_choose(n, k) -> Column:
    """Logarithm of the binomial coefficient."""
    n, k = _col(n), _col(k)
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
