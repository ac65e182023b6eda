"""Exact top-k inner-product search by distributed histogram selection.

Components are fixed-point integers, so scores are exact.  Queries are taken in slices of a bounded
size; for each slice

1. every task scores its vectors against all queries of the slice and counts the scores of each
   query in ``bins`` equal ranges between the bounds that the norms give; the counts are summed over
   all tasks.  A task sends a query's bins from the top down to where its own counts reach what is
   still wanted: the k-th value lies in one of these or above, so nothing that matters is missing;
2. the bin that holds a query's k-th score becomes its new range, and only queries that still have
   more than a few scores there are scored and counted again, until the range is one score wide;
3. queries with many equal scores at that place go on in the same way over the ids, whose order
   breaks ties;
4. a last pass keeps the pairs at or above each query's limit and ranks them.

The driver holds one slice of queries and one row of bounds for each of them; a slice's result is
written before the next one starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinerank.llm.vectors import LONG, Keeper, every, fixed_point, inner, lists, matrix, survey
from cinerank.session import materialize

K = 10
SCALE = 1024
QUERY_EVERY = 100
BINS = 512
SLICE_BYTES = 16 << 20  # of query vectors and of the counts that a task holds
SCORES = 1 << 21  # that a task holds at once
SLACK = 4  # a range with at most this many times k pairs is not refined


class Slice(NamedTuple):
    """Queries and, for each, the range of scores or (``by_id``) of inverted ids under search."""

    ids: np.ndarray
    x: np.ndarray
    lo: np.ndarray  # the range's lower end, its length and the width of its bins
    span: np.ndarray
    width: np.ndarray
    want: np.ndarray  # places not filled by what lies above the range
    by_id: np.ndarray
    score: np.ndarray  # of the ties, where by_id


def _blocks(batches: Iterator[pa.RecordBatch], n_queries: int, width: int, scale: int):
    """(ids, matrix) blocks of valid vectors, small enough for ``SCORES``."""
    step = max(64, SCORES // max(1, n_queries))
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            b = whole.slice(at, step)
            own, x = fixed_point(b.column(1), scale, width)
            if len(own):
                yield b.column(0).to_numpy(zero_copy_only=False)[own], x


def _counts(shared, bins: int, width: int, scale: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Slice = shared.value
        hist = np.zeros(len(s.ids) * bins, dtype=np.int64)
        row = np.arange(len(s.ids))[:, None] * bins
        for ids, x in _blocks(batches, len(s.ids), width, scale):
            score = inner(s.x, x)
            inverted = np.broadcast_to(~ids, score.shape)
            key = np.where(s.by_id[:, None], inverted, score) if s.by_id.any() else score
            inside = (key >= s.lo[:, None]) & (ids != s.ids[:, None])
            if s.by_id.any():
                inside &= ~s.by_id[:, None] | (score == s.score[:, None])
            # the distance from the lower end may take 64 bits
            bin_ = (key.view(np.uint64) if key.flags.c_contiguous else key.astype(np.uint64)) - s.lo[:, None].astype(np.uint64)
            inside &= bin_ < s.span[:, None]
            bin_ //= s.width[:, None]
            hist += np.bincount((row + np.minimum(bin_, bins).astype(np.int64))[inside], minlength=len(hist))
        hist = hist.reshape(len(s.ids), bins)
        above = np.cumsum(hist[:, ::-1], axis=1)[:, ::-1] - hist
        q, b = np.nonzero((hist > 0) & (above < s.want[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(b, pa.int64()), pa.array(hist[q, b], pa.int64())],
                                         names=["q", "bin", "n"])

    return count


def _select(shared, k: int, width: int, scale: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries, limit, tie = shared.value
        best = Keeper(len(names), k)
        for ids, x in _blocks(batches, len(names), width, scale):
            score = inner(queries, x)
            at_least = np.maximum(limit, best.floor)[:, None]
            q, v = np.nonzero((score >= at_least) & (ids != names[:, None]))
            s, i = score[q, v], ids[v]
            mine = (s > limit[q]) | (~i >= tie[q])
            best.add(q[mine], s[mine], i[mine])
        q, s, i = best.best()
        yield pa.RecordBatch.from_arrays([pa.array(names[q], pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.int64())],
                                         names=["query_id", "vec_id", "score"])

    return keep


def _locate(rows: DataFrame, ids: np.ndarray, x: np.ndarray, facts: tuple, k: int, scale: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(limit, tie): the k best of a query have a score over its limit, or the limit itself and an
    inverted id of at least ``tie`` (a few more pairs may have)."""
    spark = rows.sparkSession
    _, width, norm, first_id, last_id = facts
    reach = np.ceil(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1) * norm) * (1 + 1e-9)) + 1
    reach = [min(LONG, int(r)) for r in reach]
    lo, hi = [-r for r in reach], [r + 1 for r in reach]  # exact integers: ranges may take more than 64 bits
    want, by_id, at = [k] * len(ids), [False] * len(ids), [0] * len(ids)
    limit, tie = np.full(len(ids), -LONG - 1, dtype=np.int64), np.full(len(ids), -LONG - 1, dtype=np.int64)
    open_ = list(range(len(ids)))
    while open_:
        wide = [max(1, -(-(hi[q] - lo[q]) // bins)) for q in open_]
        shared = spark.sparkContext.broadcast(Slice(
            ids[open_], x[open_], np.array([lo[q] for q in open_], dtype=np.int64),
            np.array([hi[q] - lo[q] for q in open_], dtype=np.uint64), np.array(wide, dtype=np.uint64),
            np.array([want[q] for q in open_]), np.array([by_id[q] for q in open_]), np.array([at[q] for q in open_], dtype=np.int64)))
        down = Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        places = spark.createDataFrame([(i, want[q]) for i, q in enumerate(open_)], "q long, want long")
        found = rows.mapInArrow(_counts(shared, bins, width, scale), "q long, bin long, n long") \
            .groupBy("q", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down)) \
            .join(places, "q").filter((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want"))) \
            .select("q", "bin", "n", "upto").collect()  # one row a query of the slice
        shared.unpersist()
        holds = {r.q: r for r in found}
        still = []
        for i, q in enumerate(open_):
            r = holds.get(i)
            if r is None:  # fewer candidates than k: all of them
                continue
            lo[q] += r.bin * wide[i]
            hi[q] = min(hi[q], lo[q] + wide[i])
            want[q] -= r.upto - r.n
            few = r.n <= want[q] + SLACK * k
            if by_id[q]:
                tie[q] = lo[q]
            else:
                limit[q] = lo[q]
            exact = hi[q] - lo[q] == 1
            if few or (exact and by_id[q]):
                continue
            if exact:  # equal scores: go on over the ids
                by_id[q], at[q], lo[q], hi[q] = True, lo[q], ~last_id, ~first_id + 1
            still.append(q)
        open_ = still
    return limit, tie


def top_k(vectors: DataFrame, *, k: int = K, scale: int = SCALE, queries: Column | None = None, id_col: str = "vec_id",
          vector_col: str = "embedding", bins: int = BINS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` rows of largest inner product, exactly.

    Components count as floor(scale * x).  ``queries`` is a condition on ``vec_id`` (default: divisible
    by 100); candidates are all rows but those with the query's id.  Score ties go to the smaller id;
    all candidates are returned if they are fewer than ``k``.  Null ids and vectors that are null or
    hold null or non-finite components take no part; an empty vector is one of zeros, and shorter
    vectors are filled with zeros.  Rows that repeat an id are a candidate each; of several vectors
    under a query's id the smallest one asks.  Other columns are ignored.  An empty table gives no rows; a component
    beyond 62 bits or a score beyond 64 bits raises ArithmeticError.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    facts = survey(rows, scale)
    if not facts[0]:
        return spark.createDataFrame([], schema)
    width = facts[1]

    def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, x = fixed_point(b.column(1), scale, width)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own, pa.int64())), lists(x)], names=["vec_id", "x"])

    asked = materialize(rows.filter(every(QUERY_EVERY) if queries is None else queries)
                        .mapInArrow(valid, "vec_id long, x array<long>").groupBy("vec_id").agg(F.min("x").alias("x")), "topk-queries")
    n_queries = asked.count()
    slices = max(1, -(-n_queries * 8 * max(width, bins) // slice_bytes))
    done = []
    for s in range(slices):
        part = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(slices)) == s).toArrow()  # about slice_bytes at most
        if not part.num_rows:
            continue
        ids, x = part.column("vec_id").to_numpy(), matrix(part.column("x"), width)
        limit, tie = _locate(rows, ids, x, facts, k, scale, bins)
        shared = spark.sparkContext.broadcast((ids, x, limit, tie))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = rows.mapInArrow(_select(shared, k, width, scale), "query_id long, vec_id long, score long") \
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        done.append(materialize(best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "topk-slice"))
        shared.unpersist()
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], schema)
