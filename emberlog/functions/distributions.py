"""Distribution functions as column expressions: fixed sums over quadrature nodes, each row
on its own, in the JVM.

The upper tail of a normal deviate is an integral of exp(-z^2 / (2 s)) over s = sin^2 of an
angle from 0 to a right angle. Averaged over a chi-square scale this gives Student's tail
with (1 + t^2 / (df s))^(-df / 2) instead, for any degrees of freedom and without a gamma
function. The noncentral t averages the normal tail over the scale's density, whose factor
cancels. Chi-square tails are finite sums of positive terms.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _angle_nodes(step: float = 0.03, most: float = 3.3) -> list[tuple[float, float]]:
    """(sin^2, weight) of a double exponential rule over the angle; weights sum to 1/2."""
    u = np.arange(-most, most + step / 2, step)
    inner = math.pi / 2 * np.sinh(u)
    angle = math.pi / 2 / (1 + np.exp(-2 * inner))
    weight = math.pi / 4 * math.pi / 2 * np.cosh(u) / np.cosh(inner) ** 2 * step / math.pi
    return [(float(s), float(w)) for s, w in zip(np.sin(angle) ** 2, weight, strict=True) if w > 1e-22]


_ANGLES = _angle_nodes()
#: Degrees of freedom from which the deviance form of the chi-square tail is used.
MANY = 1000


def _nodes(pairs: list[tuple[float, float]]) -> Column:
    return F.expr("array(" + ", ".join(f"struct({a!r}D AS x, {w!r}D AS w)" for a, w in pairs) + ")")


def _sum(pairs: list[tuple[float, float]], term) -> Column:
    """Sum of ``w * term(x)`` over the nodes."""
    return F.aggregate(_nodes(pairs), F.lit(0.0), lambda total, n: total + n["w"] * term(n["x"]))


def normal_cdf(x: Column) -> Column:
    tail = _sum(_ANGLES, lambda s: F.exp(-x * x / (2 * s)))
    return F.when(x < 0, tail).otherwise(1 - tail)


def _t_tail(t: Column, df: Column) -> Column:
    """Upper tail beyond |t|."""
    return _sum(_ANGLES, lambda s: F.exp(-df / 2 * F.log1p(t * t / (df * s))))


def t_two_sided(t: Column, df: Column) -> Column:
    """Two-sided p-value; null where t or df is null or df is not positive."""
    return F.when((df > 0) & t.isNotNull(), F.least(F.lit(1.0), 2 * _t_tail(t, df)))


def t_upper_quantile(tail: float, df: Column, rounds: int = 25) -> Column:
    """The t whose upper tail is ``tail`` (under 1/2). Newton's steps from the normal quantile,
    which lies below, and as the tail is convex there, never step over the root."""
    start = F.lit(NormalDist().inv_cdf(1 - tail))

    def step(t: Column) -> Column:
        slope = _sum(_ANGLES, lambda s: t / s * F.exp(-(df / 2 + 1) * F.log1p(t * t / (df * s))))
        return t + (_t_tail(t, df) - tail) / slope

    return F.when(df > 0, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda t, _: step(t)))


_SCALES = [(float((x + 1) / 2), float(w)) for x, w in zip(*np.polynomial.legendre.leggauss(120), strict=True)]


def nct_cdf(t: Column, df: Column, nc: Column) -> Column:
    """Noncentral t."""
    spread = 12 / F.sqrt(2 * df)
    low, high = F.greatest(F.lit(1e-9), 1 - spread), 1 + spread

    def density(x: Column) -> Column:
        s = low + (high - low) * x
        return F.exp((df - 1) * F.log(s) - df * (s * s - 1) / 2)

    inside = _sum(_SCALES, lambda x: density(x) * normal_cdf(t * (low + (high - low) * x) - nc))
    return F.when((df > 0) & t.isNotNull() & nc.isNotNull(), F.least(F.lit(1.0), inside / _sum(_SCALES, density)))


def chi2_sf(x: Column, k: Column) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom."""
    z = x / 2
    odd = k % 2 == 1
    first = F.when(odd, 2 * F.sqrt(z / math.pi) * F.exp(-z)).otherwise(F.exp(-z))
    lead = F.when(odd, 2 * (1 - normal_cdf(F.sqrt(x)))).otherwise(F.lit(0.0))
    terms = F.floor(k / 2).cast("int")
    # term j + 1 is term j times z over j (even) or j + 1/2 (odd)
    walk = F.aggregate(
        F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(0.0).alias("sum"), first.alias("term")),
        lambda at, j: F.struct(
            (at["sum"] + at["term"]).alias("sum"), (at["term"] * z / (j + F.when(odd, 0.5).otherwise(0.0))).alias("term")
        ),
    )["sum"]
    exact = F.least(F.lit(1.0), lead + walk)
    return F.when(x.isNull(), F.lit(None)).when((k > 0) & (x <= 0), 1.0).when((k > 0) & (k <= MANY), exact).when(k > MANY, _chi2_many(x, k))


def _chi2_many(x: Column, k: Column) -> Column:
    """Signed root of the deviance with its saddle-point correction: relative error 1 / k."""
    a, u = k / 2, (x - k) / k
    series = u * u / 2 - F.pow(u, 3) / 3 + F.pow(u, 4) / 4 - F.pow(u, 5) / 5 + F.pow(u, 6) / 6 - F.pow(u, 7) / 7
    half = F.when(F.abs(u) < 1e-2, series).otherwise(u - F.log1p(u))
    root = F.signum(u) * F.sqrt(2 * a * half)
    middle = (-1 / 3 + u / 12) / F.sqrt(a)
    correction = F.when(F.abs(u) < 1e-4, middle).otherwise(1 / (u * F.sqrt(a)) - 1 / root)
    density = F.exp(-root * root / 2) / math.sqrt(2 * math.pi)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), normal_cdf(-root) + density * correction))
