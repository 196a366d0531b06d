"""Scalar column helpers.  All are built-in Catalyst expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int) -> Column:
    """Half-even rounding at ``digits`` decimals: rint(x * 10^d) / 10^d.

    Spark's ``round`` is half-up; ``bround`` works on the decimal expansion.
    rint on the scaled double reproduces numpy/pandas ``round``.
    """
    scale = float(10 ** digits)
    return F.rint(col_(c) * F.lit(scale)) / F.lit(scale)


def to_double(c) -> Column:
    """Numeric parse; anything unparsable becomes null (ANSI-safe)."""
    return col_(c).try_cast("double")


def finite_or_null(c) -> Column:
    """NaN and +-inf become null."""
    c = col_(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(INF)), F.lit(None).cast("double")).otherwise(c)


def is_infinite(c) -> Column:
    return F.abs(col_(c)) == F.lit(INF)


def safe_ratio(num, den, digits: int) -> Column:
    """num / den with den = 0 -> null -> 0, rounded half-even."""
    den = col_(den)
    q = F.try_divide(col_(num), F.when(den != 0, den))
    return F.coalesce(round_half_even(q, digits), F.lit(0.0))


def in_domain(c, lo, hi) -> Column:
    """Inclusive range test; a null value is not out of domain."""
    c = col_(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(float(lo)))
    if hi is not None:
        cond = cond & (c <= F.lit(float(hi)))
    return cond


def out_of_domain(c, lo, hi) -> Column:
    c = col_(c)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(float(lo)))
    if hi is not None:
        cond = cond | (c > F.lit(float(hi)))
    return F.coalesce(cond, F.lit(False))


def lerp(a, b, t) -> Column:
    """numpy's linear interpolation between two order statistics."""
    a, b, t = col_(a), col_(b), col_(t)
    d = b - a
    return F.when(t >= 0.5, b - d * (F.lit(1.0) - t)).otherwise(a + d * t)
