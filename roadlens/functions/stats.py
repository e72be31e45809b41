"""Distribution functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the continued fraction: enough for samples of a million and more.
TERMS = 2000
#: Gamma(x + 1/2) / Gamma(x) = sqrt(x) * sum of these over x^k for large x (fixed values).
_RATIO = [1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304]
_SHIFT = 30


def _gamma_ratio(x: Column) -> Column:
    """Gamma(x + 1/2) / Gamma(x): the series 30 further on, and the way back."""
    far = x + _SHIFT
    series = F.lit(0.0)
    for c in reversed(_RATIO):
        series = series / far + c
    back = F.aggregate(F.sequence(F.lit(0), F.lit(_SHIFT - 1)), F.lit(1.0), lambda acc, i: acc * (x + i) / (x + i + 0.5))
    return F.sqrt(far) * series * back


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """Continued fraction of the incomplete beta function by Lentz's rule; it
    stands still once a term no longer changes it."""
    tiny = 1e-300
    floor = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
    d0 = 1 / floor(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"), F.lit(False).alias("done"))

    def term(acc, m):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d1, c1 = 1 / floor(1 + even * acc["d"]), floor(1 + even / acc["c"])
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d2, c2 = 1 / floor(1 + odd * d1), floor(1 + odd / c1)
        h = acc["h"] * d1 * c1 * d2 * c2
        keep = acc["done"]
        pick = lambda old, new: F.when(keep, old).otherwise(new)
        return F.struct(pick(acc["c"], c2).alias("c"), pick(acc["d"], d2).alias("d"), pick(acc["h"], h).alias("h"),
                        (keep | (F.abs(d2 * c2 - 1) < 1e-15)).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, lambda acc, i: term(acc, i.cast("double")), lambda acc: acc["h"])


def correlation_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation of ``n`` pairs being 0 (Student's t
    with n - 2 degrees of freedom, by the incomplete beta function); null
    below 3 pairs, 0 for a correlation of 1 or -1."""
    a = (n.cast("double") - 2) / 2
    r2 = r * r
    half = F.lit(0.5)
    # 1 / B(a, 1/2) = Gamma(a + 1/2) / (Gamma(a) sqrt(pi))
    front = F.exp(a * F.log1p(-r2)) * F.sqrt(r2) * _gamma_ratio(a) / F.sqrt(F.lit(3.141592653589793))
    x = 1 - r2
    p = F.when(x < (a + 1) / (a + 2.5), front * _fraction(x, a, half) / a).otherwise(1 - front * _fraction(r2, half, a) / half)
    return F.when((n < 3) | r.isNull(), F.lit(None)).when(r2 >= 1, 0.0).when(r2 == 0, 1.0).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
