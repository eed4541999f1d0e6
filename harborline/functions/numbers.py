"""Numeric expressions and the distribution functions Spark does not ship."""

from __future__ import annotations

from math import lgamma, log, pi, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_ratio(numerator, denominator) -> Column:
    """Double division that yields null for a zero denominator."""
    return _col(numerator).cast("double") / F.nullif(
        _col(denominator).cast("double"), F.lit(0.0)
    )


def mean_of(flag) -> Column:
    """Share of rows for which a boolean holds; null flags are skipped."""
    return F.avg(_col(flag).cast("int"))


def clip(value, low: float, high: float) -> Column:
    """Limit to a closed range, keeping null as null."""
    value = _col(value)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def finite(value) -> Column:
    """Null for NaN and both infinities."""
    value = _col(value)
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


SERIES_TERMS = 50  # enough below the joint, where a term shrinks by 2 z^2 / (2 n + 1)
FRACTION_DEPTH = 40  # enough above it
JOINT = 2.5


def erfc(z) -> Column:
    """Complementary error function of a non-negative column, to about 1e-12 of its value.

    Below the joint one minus the power series of erf, whose terms are all positive; above
    it the continued fraction, from its tail forwards.
    """
    z = _col(z)

    def folded(steps: int, start: Column, step) -> Column:
        """Fold ``step`` over steps, steps - 1, ..., 1; the state keeps ``x`` and ``made``."""
        state = F.struct(start.alias("x"), F.lit(1.0).alias("made"))
        down = F.sequence(F.lit(steps), F.lit(1), F.lit(-1))
        return F.aggregate(down, state, lambda s, n: F.struct(s["x"].alias("x"), step(s, n).alias("made")),
                           lambda s: s["made"])

    series = folded(SERIES_TERMS, z * z, lambda s, n: F.lit(1.0) + F.lit(2.0) / (2 * n + 1) * s["x"] * s["made"])
    near = F.lit(1.0) - F.lit(2.0 / sqrt(pi)) * z * F.exp(-z * z) * series
    # The outermost partial numerator comes last; the innermost tail is z itself, which 1 stands in for.
    tail = folded(FRACTION_DEPTH, z, lambda s, n: s["x"] + n / F.lit(2.0) / s["made"])
    return F.when(z < JOINT, near).otherwise(F.exp(-z * z) / (F.lit(sqrt(pi)) * tail))


def two_sided_normal_p(z) -> Column:
    """Probability of a standard normal at least as far out as ``z``."""
    return erfc(F.abs(_col(z)) / F.lit(sqrt(2.0)))


def two_proportion_p(hits_a, total_a, hits_b, total_b) -> Column:
    """Pooled two-sided z test of two proportions; 1 when a side is empty or constant."""
    ha, na, hb, nb = (_col(c).cast("double") for c in (hits_a, total_a, hits_b, total_b))
    both = (na > 0) & (nb > 0)
    pooled = F.when(both, (ha + hb) / (na + nb))
    variance = F.when(both, pooled * (1 - pooled) * (1 / na + 1 / nb))
    z = F.when(variance > 0, (hb / nb - ha / na) / F.sqrt(variance))
    return F.when(variance > 0, two_sided_normal_p(z)).otherwise(F.lit(1.0))


def _log_gamma(x: Column) -> Column:
    """log of the gamma function above 50, by Stirling's series."""
    return (x - 0.5) * F.log(x) - x + F.lit(log(2 * pi) / 2) + 1 / (12 * x) - 1 / (360 * x * x * x)


def chi2_sf(statistic, freedom) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom.

    The tail has a closed form: ``freedom/2`` Poisson-like terms, plus one ``erfc``
    when the degrees are odd. Terms are carried as logarithms so that none overflows. Only
    terms within 40 standard deviations of the largest one are summed; what lies outside is
    beyond the precision of a double, so the array has about 80 sqrt(statistic) entries
    however many degrees there are.
    """
    y = _col(statistic).cast("double") / 2
    k = _col(freedom).cast("bigint")
    odd = k % 2 == 1
    log_y = F.log(y)
    terms = F.when(odd, (k - 1) / 2).otherwise(k / 2).cast("bigint")
    step = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    reach = 40 * F.sqrt(y) + 100
    low = F.floor(y - reach)
    low = F.when(low < 100, F.lit(0)).otherwise(low).cast("bigint")
    high = F.least(terms, F.ceil(y + reach).cast("bigint"))
    # The term number i is y^(i + step) e^-y / gamma(i + step + 1).
    at_zero = F.when(odd, log_y / 2 - y - F.lit(lgamma(1.5))).otherwise(-y)
    place = low + step
    first = F.when(low == 0, at_zero).otherwise(place * log_y - y - _log_gamma(place + 1))

    def add(state, i):
        return F.struct(
            (state["log_term"] + log_y - F.log(i + step)).alias("log_term"),
            (state["total"] + F.exp(state["log_term"])).alias("total"),
        )

    start = F.struct(first.alias("log_term"), F.lit(0.0).alias("total"))
    series = F.when(
        high > low,
        F.aggregate(F.sequence(low + 1, F.greatest(high, low + 1)), start, add)["total"],
    ).otherwise(0.0)
    tail = series + F.when(odd, erfc(F.sqrt(y))).otherwise(0.0)
    return F.when(y <= 0, F.lit(1.0)).otherwise(F.least(tail, F.lit(1.0)))
