"""Special functions as column expressions, for p-values."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions.cleaning import as_col

# Lanczos approximation of the gamma function, g = 7, 9 terms.
LANCZOS_G = 7
LANCZOS = (
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
)

#: Steps of the continued fraction. It settles after some square root of the
#: parameters; further steps change nothing.
STEPS = 400
TINY = 1e-300


def log_gamma(x: Column | str) -> Column:
    """Logarithm of the gamma function for x of at least 0.5."""
    z = as_col(x) - 1
    terms = [F.lit(LANCZOS[0]), *[F.lit(c) / (z + i) for i, c in enumerate(LANCZOS) if i]]
    t = z + LANCZOS_G + 0.5
    return F.log(F.lit(2) * F.pi()) / 2 + (z + 0.5) * F.log(t) - t + F.log(reduce(add, terms))


def _kept_apart(x: Column) -> Column:
    """A divisor that is never zero."""
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, by Lentz's method."""

    def factor(m: Column, odd: bool) -> Column:
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))

    def step(state: Column, d: Column) -> Column:
        lower = 1 / _kept_apart(1 + d * state["lower"])
        upper = _kept_apart(1 + d / state["upper"])
        return F.struct(
            upper.alias("upper"), lower.alias("lower"), (state["value"] * upper * lower).alias("value")
        )

    first = 1 / _kept_apart(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("upper"), first.alias("lower"), first.alias("value"))
    # Both factors of a round, in one list, so that a state is computed once.
    rounds = F.sequence(F.lit(1), F.lit(STEPS))
    factors = F.flatten(F.transform(rounds, lambda m: F.array(factor(m.cast("double"), False), factor(m.cast("double"), True))))
    return F.aggregate(factors, start, step)["value"]


def beta_share(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function I_x(a, b) for a, b of at least 0.5."""
    front = F.exp(
        log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log1p(-x)
    )
    low = front * _fraction(a, b, x) / a
    high = 1 - front * _fraction(b, a, 1 - x) / b
    return (
        F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x < (a + 1) / (a + b + 2), low).otherwise(high)
    )


def student_p(t: Column | str, df: Column | str) -> Column:
    """Two-sided p of Student's t; null for a null t or less than 1 degree."""
    value, degrees = as_col(t).cast("double"), as_col(df).cast("double")
    x = degrees / (degrees + value * value)
    return F.when(value.isNotNull() & (degrees >= 1), beta_share(degrees / 2, F.lit(0.5), x))
