"""Scalar column helpers.

Scores are carried as integers in millionths ("micro units").  A score is computed as
exact sums followed by one IEEE division and then ``floor(x * 1e6 + 0.5)``; every step
is correctly rounded, so any engine evaluating the same expression gets the same bits,
and ranking on the integer makes ties explicit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncated(c) -> Column:
    """Integer part of a rating (toward zero), as an integer cast of text does.

    Goes through DOUBLE: with ANSI mode on, casting the text '4.5' to INT raises.
    """
    d = _c(c).cast("double")
    return F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d))


def micro(x) -> Column:
    """``floor(x * 1e6 + 0.5)`` as BIGINT: the value in millionths, rounded half up."""
    return F.floor(_c(x) * F.lit(MICRO) + F.lit(0.5))


def from_micro(m) -> Column:
    return _c(m).cast("double") / F.lit(MICRO)


def hash_u32(*parts) -> Column:
    """Unsigned 32-bit value from the first 8 hex digits of ``md5('p1:p2:…')``.

    md5 is chosen because other engines compute the same digest, so draws are
    reproducible outside Spark.
    """
    text = F.concat_ws(":", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def unit_interval(*parts) -> Column:
    """Uniform value in [0, 1) from ``hash_u32`` (exact: division by 2^32)."""
    return hash_u32(*parts).cast("double") / F.lit(4294967296.0)
