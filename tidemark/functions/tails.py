"""Tail probabilities as native column expressions.

Every function folds over a short sequence with ``aggregate``, so p-values are
computed inside the JVM on the one-row-per-feature result.  Arguments are SQL
fragments (usually column names); the formulas are written as SQL because the
nested folds read better that way and are parsed in one call.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_ROOT_PI = repr(math.sqrt(math.pi)) + "D"
_ROOT_2 = repr(math.sqrt(2)) + "D"


def _erfc_sql(z: str) -> str:
    """Complementary error function for ``z >= 0``.

    Below 2 the all-positive power series of erf is summed; above, the
    continued fraction is evaluated from its tail.
    """
    series = (
        f"aggregate(sequence(1, 60), named_struct('term', z, 'total', z), (acc, k) -> named_struct("
        f"'term', acc.term * z * z * 2 / (2 * k + 1), "
        f"'total', acc.total + acc.term * z * z * 2 / (2 * k + 1))).total"
    )
    fraction = "aggregate(sequence(80, 1), 0D, (acc, k) -> (k / 2D) / (z + acc))"
    return (
        f"transform(array(CAST({z} AS DOUBLE)), z -> CASE "
        f"WHEN z < 2 THEN 1 - 2 / {_ROOT_PI} * exp(-z * z) * {series} "
        f"ELSE exp(-z * z) / {_ROOT_PI} / (z + {fraction}) END)[0]"
    )


def erfc(z: str) -> Column:
    return F.expr(_erfc_sql(z))


def normal_two_sided(z: str) -> Column:
    """``P(|Z| >= |z|)`` for a standard normal."""
    return F.expr(_erfc_sql(f"abs({z}) / {_ROOT_2}"))


def chi2_tail(stat: str, dof: str) -> Column:
    """``P(X >= stat)`` for a chi-squared variable with any positive ``dof``.

    The regularised incomplete gamma function with shape ``a = dof / 2`` at
    ``y = stat / 2``: its power series below ``a + 1``, its continued fraction
    above.  Either settles within a number of terms that grows with the root of
    ``a``; only the terms near the mode of a large shape count.
    """
    a, y = f"({dof} / 2D)", f"({stat} / 2D)"
    steps = f"sequence(1, CAST(60 + 12 * sqrt({a}) AS INT))"
    # ln Gamma by Stirling's series, after moving small arguments up by the recurrence
    up = "aggregate(sequence(0, 11), 0D, (s, i) -> s + ln(a + i))"
    w = "(a + 12)"
    stirling = (
        f"(({w} - 0.5D) * ln({w}) - {w} + {0.5 * math.log(2 * math.pi)!r}D + 1 / (12 * {w}) "
        f"- 1 / (360 * {w} * {w} * {w}) + 1 / (1260 * pow({w}, 5)) - 1 / (1680 * pow({w}, 7)) + 1 / (1188 * pow({w}, 9)))"
    )
    scale = f"exp(a * ln(y) - y - ({stirling} - {up}))"
    series = (
        f"aggregate({steps}, named_struct('term', 1 / a, 'total', 1 / a), (s, k) -> named_struct("
        "'term', s.term * y / (a + k), 'total', s.total + s.term * y / (a + k))).total"
    )
    # Lentz's form of the continued fraction
    lentz = (
        f"aggregate({steps}, named_struct('b', y + 1 - a, 'c', 1e300D, 'd', 1 / (y + 1 - a), "
        "'h', 1 / (y + 1 - a)), (s, k) -> transform(array(named_struct("
        "'b', s.b + 2, 'd', 1 / (-k * (k - a) * s.d + s.b + 2), "
        "'c', s.b + 2 - k * (k - a) / s.c, 'h', s.h)), "
        "n -> named_struct('b', n.b, 'c', n.c, 'd', n.d, 'h', n.h * n.c * n.d))[0]).h"
    )
    tail = (
        f"transform(array(named_struct('a', CAST({a} AS DOUBLE), 'y', CAST({y} AS DOUBLE))), "
        f"v -> transform(array(v.a), a -> transform(array(v.y), y -> "
        f"IF(y < a + 1, 1 - {scale} * {series}, {scale} * {lentz}))[0])[0])[0]"
    )
    return F.expr(
        f"CASE WHEN {stat} IS NULL OR {dof} IS NULL OR {dof} < 1 THEN CAST(NULL AS DOUBLE) "
        f"WHEN {stat} <= 0 THEN 1D WHEN {stat} = double('infinity') THEN 0D "
        f"ELSE least(greatest({tail}, 0D), 1D) END"
    )


def kolmogorov_tail(statistic: str, n: str, m: str, corrected: bool = True) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value.

    ``corrected`` applies the small-sample factor to the scaled statistic; the
    plain limit distribution is used otherwise.  The alternating series does not
    converge near zero, where the tail is 1.
    """
    root = f"sqrt(CAST({n} AS DOUBLE) * {m} / ({n} + {m}))"
    factor = f"({root} + 0.12D + 0.11D / {root})" if corrected else root
    series = (
        "aggregate(sequence(1, 100), 0D, (acc, k) -> acc + "
        "IF(k % 2 = 1, 1D, -1D) * exp(-2D * k * k * lam * lam))"
    )
    return F.expr(
        f"transform(array({factor} * {statistic}), lam -> CASE WHEN lam IS NULL THEN NULL "
        f"WHEN lam < 0.2 THEN 1D ELSE least(greatest(2 * {series}, 0D), 1D) END)[0]"
    )
