"""Numeric helpers that give the same bits on every engine and every plan.

* ``rnd`` scales, rounds half away from zero, and scales back.  Spark's
  ``round(double, n)`` goes through a decimal, which differs on values such as
  1.005 and is about six times slower; here the scaled value is rounded with
  ``rint`` (a CPU instruction) and exact ties (fraction exactly 0.5, tested
  with an exact ``% 1.0``) are moved away from zero.  A zero result is
  always +0.0.
* Averages and standard deviations are computed from integer moments
  (count, sum, sum of squares), which are exact, associative and therefore
  independent of partitioning, so re-aggregating partial results is exact too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_away(y: Column) -> Column:
    """Nearest integer (as a double), ties away from zero; NaN and +-inf unchanged."""
    frac = y % F.lit(1.0)                    # exact, keeps the sign of y
    return F.when(F.abs(frac) == F.lit(0.5), y - frac + F.signum(y)).otherwise(F.rint(y))


def rnd(x, digits: int) -> Column:
    """round(x * 10^d) / 10^d with half-away-from-zero rounding, as a double."""
    scale = F.lit(float(10 ** digits))
    r = round_half_away(_c(x).cast("double") * scale) / scale
    return F.when(r == F.lit(0.0), F.lit(0.0)).otherwise(r)


def safe_div(num, den) -> Column:
    """num / den as double, NULL when den is 0 (ANSI mode would raise)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def pct(part, whole) -> Column:
    """part * 100 / whole as double, NULL on an empty whole."""
    return safe_div(_c(part).cast("double") * F.lit(100.0), whole)


def to_units(x, digits: int) -> Column:
    """A value with ``digits`` decimals as an exact integer count of units."""
    return round_half_away(_c(x).cast("double") * F.lit(float(10 ** digits))).cast("bigint")


def stddev_from_moments(n, s1, s2) -> Column:
    """Sample standard deviation from exact integer count, sum and sum of squares.

    var = (n*s2 - s1^2) / (n*(n-1)); the numerator is evaluated in decimal(38,0)
    so it is exact, NULL for n < 2 as the SQL aggregate.
    """
    n_dec = _c(n).cast("decimal(38,0)")
    numer = n_dec * _c(s2).cast("decimal(38,0)") - _c(s1).cast("decimal(38,0)") * _c(s1).cast("decimal(38,0)")
    denom = _c(n).cast("double") * (_c(n).cast("double") - F.lit(1.0))
    return F.sqrt(numer.cast("double") / F.nullif(denom, F.lit(0.0)))
