"""Dense vector similarity on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squared_norm(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x * x)


def dense_cosine(a, b, na=None, nb=None) -> Column:
    """Cosine of two equal-length DOUBLE arrays.

    Unequal lengths fail the job; a zero denominator returns the numerator (0).  ``na``, ``nb``: the arrays'
    ``squared_norm``, where rows of many pairs carry them.
    """
    a, b = _c(a), _c(b)
    num = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    na = squared_norm(a) if na is None else _c(na)
    nb = squared_norm(b) if nb is None else _c(nb)
    den = F.sqrt(na) * F.sqrt(nb)
    value = F.when(den == 0, num).otherwise(num / den)
    return F.when(F.size(a) != F.size(b),
                  F.raise_error(F.lit("cosine of arrays with different lengths"))).otherwise(value)
