"""Column expressions (all built-in Spark functions, evaluated in generated JVM code)."""

from cinerank.functions.columns import (
    hash_u32,
    micro,
    truncated,
    unit_interval,
)
from cinerank.functions.genres import (
    MOVIELENS_GENRES,
    NO_GENRES,
    TEST_VIEW_GENRES,
    multi_hot,
    split_genres,
)
from cinerank.functions.vectors import dense_cosine

__all__ = [
    "hash_u32",
    "micro",
    "truncated",
    "unit_interval",
    "MOVIELENS_GENRES",
    "NO_GENRES",
    "TEST_VIEW_GENRES",
    "multi_hot",
    "split_genres",
    "dense_cosine",
]
