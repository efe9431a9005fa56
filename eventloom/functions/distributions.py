"""Distribution functions as column expressions: log gamma, incomplete beta, Student's t and the normal quantile.

Everything is a fold over a short sequence, so it runs on the executors beside the statistic it belongs to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Stirling's series, 1 / 12 z, - 1 / 360 z ** 3 and so on.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
_SHIFT = 12
_TINY = 1e-300

#: Terms of the continued fraction, and halvings of the search for a quantile.
TERMS, HALVINGS = 300, 200


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _series(z: Column) -> Column:
    return sum((F.lit(c) / F.pow(z, F.lit(2.0 * k + 1)) for k, c in enumerate(_STIRLING)), F.lit(0.0))


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for z > 0: Stirling's series at z + 12, brought back by the recurrence."""
    high = z + _SHIFT
    stirling = (high - 0.5) * F.log(high) - high + F.lit(0.9189385332046727) + _series(high)
    return stirling - sum((F.log(z + k) for k in range(1, _SHIFT)), F.log(z))


def log_rise(a: Column, b: Column) -> Column:
    """log_gamma(a + b) - log_gamma(a), without the loss of digits that the difference of two large logarithms has."""
    high = a + _SHIFT
    steep = (high - 0.5) * F.log1p(b / high) + b * F.log(high + b) - b + _series(high + b) - _series(high)
    return steep - sum((F.log1p(b / (a + k)) for k in range(1, _SHIFT)), F.log1p(b / a))


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's method; it stops moving once it has converged."""

    def safe(v: Column) -> Column:
        return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))

        def turn(c: Column, d: Column, h: Column, by: Column) -> Column:
            return F.struct((1 + by / c).alias("c"), (1 + by * d).alias("d"), h.alias("h"))

        def finish(t: Column) -> Column:
            return _let(
                F.struct(safe(t["c"]).alias("c"), (1 / safe(t["d"])).alias("d"), t["h"].alias("h")),
                lambda u: F.struct(u["c"].alias("c"), u["d"].alias("d"), (u["h"] * u["c"] * u["d"]).alias("h")),
            )

        moved = _let(turn(s["c"], s["d"], s["h"], even), finish)
        moved = _let(moved, lambda u: _let(turn(u["c"], u["d"], u["h"], odd), finish))
        return F.when(s["done"], s).otherwise(
            _let(
                moved,
                lambda u: F.struct(
                    u["c"].alias("c"), u["d"].alias("d"), u["h"].alias("h"), (F.abs(u["h"] / s["h"] - 1) < 1e-16).alias("done")
                ),
            )
        )

    def begin(d: Column) -> Column:
        return F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"), F.lit(False).alias("done"))

    first = _let(1 / safe(1 - (a + b) * x / (a + 1)), begin)
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), first, lambda s, m: step(s, m.cast("double")))["h"]


def incomplete_beta(x: Column, a: Column, b: Column, rest: Column | None = None) -> Column:
    """The regularised incomplete beta function I_x(a, b) for 0 <= x <= 1.

    ``rest`` is 1 - x where the caller knows it to more digits than that difference has. One of ``a`` and ``b`` may be of any size;
    the number of terms is meant for an other one of at most some thousands. The error is below 1e-10 for up to 1e10 and grows in proportion from there.
    """

    def side(x: Column, rest: Column, a: Column, b: Column) -> Column:
        log_x = F.when(x > 0.5, F.log1p(-rest)).otherwise(F.log(x))
        log_rest = F.when(rest > 0.5, F.log1p(-x)).otherwise(F.log(rest))
        small = F.least(a, b)
        front = F.exp(a * log_x + b * log_rest + log_rise(F.greatest(a, b), small) - log_gamma(small))
        return front * _fraction(x, a, b) / a

    x, a, b = (v.cast("double") for v in (x, a, b))
    rest = 1 - x if rest is None else rest
    # The fraction converges fast on the side of the mean that x lies on; the other side follows by symmetry. With a very large a
    # that takes an x well below the mean: nearer to it the other side needs fewer terms.
    below = (x <= (a + 1) / (a + b + 2)) & ((a < 1000) | (rest * (a + b) > 8))
    inside = F.when(below, side(x, rest, a, b)).otherwise(1 - side(rest, x, b, a))
    return F.when(x <= 0, F.lit(0.0)).when(rest <= 0, F.lit(1.0)).otherwise(inside)


def t_two_sided(t: Column, freedom: Column) -> Column:
    """Probability that Student's t with ``freedom`` degrees of freedom is at least as far from 0 as ``t``; 0 for an infinite one."""
    square = t * t
    return F.when(square == F.lit(float("inf")), F.lit(0.0)).otherwise(
        incomplete_beta(freedom / (freedom + square), freedom / 2, F.lit(0.5), square / (freedom + square))
    )


def t_quantile(two_sided: float, freedom: Column) -> Column:
    """The t whose :func:`t_two_sided` is ``two_sided``, by halving an interval that is doubled until it holds it."""
    freedom = freedom.cast("double")
    goal = F.lit(float(two_sided))
    high = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)), F.lit(2.0), lambda h, _: F.when(t_two_sided(h, freedom) > goal, 2 * h).otherwise(h)
    )

    def halve(s: Column, _: Column) -> Column:
        return _let(
            (s["low"] + s["high"]) / 2,
            lambda middle: F.when((middle <= s["low"]) | (middle >= s["high"]), s).otherwise(
                F.when(t_two_sided(middle, freedom) > goal, F.struct(middle.alias("low"), s["high"].alias("high"))).otherwise(
                    F.struct(s["low"].alias("low"), middle.alias("high"))
                )
            ),
        )

    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), F.struct(F.lit(0.0).alias("low"), high.alias("high")), halve)
    return _let(found, lambda s: (s["low"] + s["high"]) / 2)


def atanh(x: Column) -> Column:
    return 0.5 * (F.log1p(x) - F.log1p(-x))


def normal_two_sided(share: float) -> float:
    """The deviation that a normal variable exceeds either way with probability ``share``; a constant of the plan."""
    from statistics import NormalDist

    return NormalDist().inv_cdf(1 - share / 2)
