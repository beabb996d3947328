"""Quantiles of the normal and of Student's t distribution as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col

# Coefficients of algorithm AS 241 (Wichura 1988), highest power first.
# One (numerator, denominator) pair for the centre, the shoulder and the far tail.
AS241_CENTRE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
    (5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
     5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0),
)
AS241_SHOULDER = (
    (7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
     3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
     0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0),
)
AS241_TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
     0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
    (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
     0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0),
)


def _horner(coefficients: Sequence[float], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def _ratio(pair, x: Column) -> Column:
    return _horner(pair[0], x) / _horner(pair[1], x)


def normal_quantile(p: Column | str) -> Column:
    """Inverse of the standard normal distribution function, 0 < p < 1; NULL elsewhere."""
    p = as_col(p)
    q = p - F.lit(0.5)
    tail = F.sqrt(-F.ln(F.least(p, F.lit(1.0) - p)))
    size = F.when(tail <= 5.0, _ratio(AS241_SHOULDER, tail - F.lit(1.6))).otherwise(
        _ratio(AS241_TAIL, tail - F.lit(5.0))
    )
    centre = q * _ratio(AS241_CENTRE, F.lit(0.180625) - q * q)
    value = F.when(F.abs(q) <= 0.425, centre).when(q < 0, -size).otherwise(size)
    return F.when((p > 0) & (p < 1), value)


def plotting_position(rank: Column, n: Column) -> Column:
    """(rank - a) / (n + 1 - 2a) with a = 3/8 up to ten values and 1/2 above."""
    a = F.when(n <= 10, F.lit(0.375)).otherwise(F.lit(0.5))
    return (rank - a) / (n + F.lit(1.0) - F.lit(2.0) * a)


def _t_within(t: float, df: float) -> float:
    """P(|T| < t) for any degrees of freedom: a regularised incomplete beta function by its continued fraction."""
    x, a, b = t * t / (df + t * t), 0.5, df / 2

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
        d = 1 / d
        value = d
        for m in range(1, 1000):
            for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                         -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 / (1 + step * d), 1 + step / c
                value *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return value

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a
    return 1 - front * fraction(b, a, 1 - x) / b


def t_quantile(level: float, df: float) -> float:
    """Two-sided quantile for any positive degrees of freedom, by bisection."""
    low, high = 1e-9, 1.0
    while _t_within(high, df) < level:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _t_within(middle, df) < level else (low, middle)
    return (low + high) / 2


NODES = 96  # of the Gauss-Legendre rule
SHIFT = 30  # steps up before the expansion of the gamma ratio
# The expansion of gamma(n + 1/2) / (gamma(n) sqrt(n)) in powers of 1/n, highest power first.
GAMMA_RATIO = (39325 / 33554432, 869 / 4194304, -399 / 262144, -21 / 32768, 5 / 1024, 1 / 128, -1 / 8, 1.0)


def _gamma_ratio(n: Column) -> Column:
    """gamma(n + 1/2) / gamma(n) for n >= 1/2."""
    up = n + F.lit(float(SHIFT))
    steps = F.transform(F.sequence(F.lit(0), F.lit(SHIFT - 1)), lambda j: (n + j) / (n + j + F.lit(0.5)))
    return F.sqrt(up) * _horner(GAMMA_RATIO, F.lit(1.0) / up) * F.aggregate(steps, F.lit(1.0), lambda a, x: a * x)


def t_multiplier(df: Column | float, level: float = 0.95) -> Column:
    """Half-width multiplier of a two-sided t interval, for any degrees of freedom from one on; NULL below.

    With t = sqrt(df) tan(u), the probability within t is an integral of cos^(df - 1) from 0 to u. It is
    summed by one Gauss-Legendre rule, and u found by halving, in one expression for all degrees of freedom.
    """
    if not isinstance(df, Column):
        return F.lit(t_quantile(level, df) if df >= 1 else None).cast("double")
    places, weights = np.polynomial.legendre.leggauss(NODES)
    rule = F.expr("array(" + ", ".join(f"struct({(x + 1) / 2!r}D AS x, {w / 2!r}D AS w)" for x, w in zip(places.tolist(), weights.tolist())) + ")")
    df = df.cast("double")
    # One row of one struct, so that the factor before the integral is worked out once.
    given = F.array(F.struct(df.alias("df"), (_gamma_ratio(df / 2) * F.lit(2 / math.sqrt(math.pi))).alias("front")))

    def solved(g: Column) -> Column:
        def within(u: Column) -> Column:
            def term(p: Column) -> Column:
                sine = F.sin(u * p["x"])
                return p["w"] * F.exp((g["df"] - 1) / 2 * F.log1p(-sine * sine))

            return g["front"] * u * F.aggregate(rule, F.lit(0.0), lambda a, p: a + term(p))

        def halved(ends: Column, _: Column) -> Column:
            # The middle is in relative steps while the lower end is far below, as u is small for many degrees of freedom.
            middle = F.when(ends["low"] * 4 < ends["high"], F.sqrt(ends["low"] * ends["high"])).otherwise(
                (ends["low"] + ends["high"]) / 2)
            return F.transform(F.array(middle), lambda m: F.when(
                within(m) < F.lit(level), F.struct(m.alias("low"), ends["high"].alias("high"))).otherwise(
                F.struct(ends["low"].alias("low"), m.alias("high"))))[0]

        start = F.struct(F.lit(1e-150).alias("low"), F.lit(math.pi / 2).alias("high"))
        u = F.aggregate(F.sequence(F.lit(1), F.lit(75)), start, halved)
        return F.sqrt(g["df"]) * F.tan((u["low"] + u["high"]) / 2)

    return F.when(df >= 1, F.transform(given, solved)[0])
