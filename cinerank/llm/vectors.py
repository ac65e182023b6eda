"""Fixed-point vectors in Arrow batches: exact integer components, exact inner products, bounded keepers.

Shared by the exact vector operators (top-k search, hard negatives, centroid clustering).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT_FLOAT = 1 << 53  # whole numbers below this are exact in doubles
LONG = (1 << 63) - 1


def fixed_point(column: pa.Array, scale: int, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, int64 matrix of floor(scale * x)) of the rows that are neither null nor hold a
    null or non-finite component.  Shorter rows are filled with zeros to ``width`` (default: the longest).

    A component beyond 62 bits raises ArithmeticError, as an overflow does in Spark's ANSI mode.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    held = np.maximum(sizes, 0)
    row = np.repeat(np.arange(len(sizes)), held)
    good = sizes >= 0
    good[row[~np.isfinite(flat)]] = False
    rows = np.flatnonzero(good)
    width = int(held[rows].max(initial=0)) if width is None else width
    mine = good[row]
    with np.errstate(over="ignore"):
        whole = np.floor(flat[mine] * float(scale))
    if len(whole) and not np.abs(whole).max() < 2.0 ** 62:
        raise ArithmeticError("a component leaves 62 bits as a fixed-point number")
    if len(rows) and (held[rows] == width).all():
        return rows, whole.astype(np.int64).reshape(len(rows), width)
    out = np.zeros((len(rows), width), dtype=np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(held) - held, held)
    place = np.cumsum(good) - 1
    out[place[row[mine]], at[mine]] = whole
    return rows, out


def lists(x: np.ndarray) -> pa.Array:
    """The rows of an int64 matrix as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.int64()))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The int64 matrix of a list column whose rows all have ``width`` components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def most(x: np.ndarray) -> int:
    return int(np.abs(x).max()) if x.size else 0


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two int64 matrices, as int64 (rows of a x rows of b)."""
    bound = a.shape[1] * most(a) * most(b)
    if bound < EXACT_FLOAT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound > LONG:
        raise ArithmeticError("inner products leave 64 bits")
    return a @ b.T


def survey(rows: DataFrame, scale: int) -> tuple[int, int, float, int, int]:
    """(rows, longest, largest squared norm rounded up, smallest id, largest id) of the valid
    vectors of ``rows`` (vec_id, v); one row a task reaches the final aggregate."""

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, width, norm, low, high = 0, 0, 0.0, LONG, -LONG - 1
        for b in batches:
            own, x = fixed_point(b.column(1), scale)
            if len(own):
                ids = b.column(0).to_numpy(zero_copy_only=False)[own]
                n, width = n + len(own), max(width, x.shape[1])
                norm = max(norm, float((x.astype(np.float64) ** 2).sum(axis=1).max()))
                low, high = min(low, int(ids.min())), max(high, int(ids.max()))
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "w": [width], "m": [norm], "lo": [low], "hi": [high]})

    f = rows.mapInArrow(facts, "n long, w long, m double, lo long, hi long").agg(
        F.sum("n").alias("n"), F.max("w").alias("w"), F.max("m").alias("m"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if not f.n:
        return 0, 0, 0.0, 0, 0
    return int(f.n), int(f.w), float(f.m) * (1 + 1e-9), int(f.lo), int(f.hi)


def every(n: int) -> Column:
    """Rows whose vec_id is divisible by n."""
    return F.col("vec_id") % n == 0


class Keeper:
    """The best ``k`` (score descending, id ascending) of each slot, from many batches of pairs.

    Memory stays below slots x k plus one limit of pending pairs, whatever comes in.
    """

    def __init__(self, slots: int, k: int, limit: int = 1 << 20) -> None:
        self.k, self.limit = k, limit
        self.floor = np.full(slots, -LONG - 1, dtype=np.int64)  # below this a pair can't be among the best
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(slot):
            self.parts.append((slot, score, ids))
            self.held += len(slot)
            if self.held > self.limit:
                self._cut()
                self.limit = max(self.limit, 4 * self.held)

    def _cut(self) -> None:
        slot, score, ids = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, ~score, slot))  # ~score falls as score rises, without an overflow
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        last = place == self.k - 1
        self.floor[slot[last]] = score[last]
        mine = place < self.k
        self.parts = [(slot[mine], score[mine], ids[mine])]
        self.held = int(mine.sum())

    def settle(self) -> None:
        """Raises the floors to what is held now."""
        if self.parts:
            self._cut()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all that is left."""
        if not self.parts:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        self._cut()
        return self.parts[0]
