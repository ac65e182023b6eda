"""Hard-negative mining over a GNAT-style multiway hyperplane tree, exactly.

Scores are inner products s of fixed-point integers.  Every row gets one more component that brings
it to the largest norm M, anchors get a zero there, so the squared distance of anchor and row is
``|a|^2 + M^2 - 2 s``: a window of scores is an annulus around the anchor.

* The tree is fitted on a bounded sample: a node has up to ``ways`` split points far from each
  other, and a row goes to the child of its nearest one (ties: the first), so children are
  separated by hyperplanes.  Every row is routed to a leaf, and the table is written clustered by leaf.
* Each split point stores the range of its distances to *all* rows of every sibling's subtree (one
  aggregate over the table).  By the triangle inequality a subtree can hold a row of the annulus
  [r1, r2] around an anchor at distance D of the split point only if its range meets
  [max(D - r2, r1 - D), D + r2]; otherwise it is left out.  Ranges are widened by the rounding error.
* Leaves are read in blocks of bounded size, whatever the leaf's size.  A block is tested once
  more with its own ranges and with the anchors' annuli as narrowed by what the task has found; then
  it is scored exactly.  Tasks return the best few rows of each window, and a window over all tasks
  ranks them.
* Anchors are taken in slices of bounded size: first their own leaf gives each a bound for its
  positives, then the positives, then the negatives in the positives' windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinerank.llm.vectors import LONG, Keeper, every, fixed_point, inner, lists, matrix, survey
from cinerank.session import materialize

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # per cent of the positive's score
SCALE = 256
ANCHOR_EVERY = 100
WAYS = 8
SAMPLE_ROWS = 16_384
LEAF_SAMPLE = 32
BLOCK = 2048
SLICE_BYTES = 8 << 20  # of anchors' vectors
SCORES = 1 << 21
LEAST = -LONG - 1


class Tree:
    """Split points with their siblings' distance ranges, as arrays; fitted on a sample.

    Node n has the points ``points[first[n]:first[n + 1]]``; ``child`` of a point is a node, or ~leaf.
    """

    def __init__(self, sample: np.ndarray, top: float, ways: int = WAYS, leaf_rows: int = LEAF_SAMPLE, seed: int = 11) -> None:
        self.top = top  # the largest squared norm
        self.points, self.first, self.child = [], [0], []
        self.path: list[list[int]] = []  # of each leaf: the points that lead to it
        self.root = self._grow(sample, self.lift(sample), np.arange(len(sample)), ways, leaf_rows, np.random.default_rng(seed), [])
        self.points = np.array(self.points, dtype=np.int64).reshape(len(self.points), sample.shape[1])
        self.extra = self.lift(self.points)
        self.first, self.child = np.array(self.first), np.array(self.child, dtype=np.int64)
        self.node_of = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        self.low = self.high = None  # ranges[point i, way j]

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.top - (x.astype(np.float64) ** 2).sum(axis=1)))

    def _grow(self, x, extra, own, ways, leaf_rows, rng, path) -> int:
        # Split points are placed node by node in breadth, so a node's points are contiguous.
        todo, root = [(own, path, -1)], None
        while todo:
            own, path, parent = todo.pop(0)
            chosen = self._spread(x, extra, own, ways, rng) if len(own) > leaf_rows else []
            if len(chosen) < 2:
                self.path.append(path)
                here = ~(len(self.path) - 1)
            else:
                here = len(self.first) - 1
                at = len(self.points)
                self.points += [x[c] for c in chosen]
                self.child += [0] * len(chosen)
                self.first.append(len(self.points))
                near = self.near(x[own], extra[own], x[chosen], extra[chosen]).argmin(axis=1)
                todo += [(own[near == w], [*path, at + w], at + w) for w in range(len(chosen))]
            if parent < 0:
                root = here
            else:
                self.child[parent] = here
        return root

    def _spread(self, x, extra, own, ways, rng) -> list[int]:
        """Up to ``ways`` rows, each the farthest of a few random ones from those before."""
        pool = rng.choice(own, min(len(own), 8 * ways), replace=False)
        chosen = [int(pool[0])]
        gap = self.near(x[pool], extra[pool], x[chosen], extra[chosen])[:, 0]
        while len(chosen) < ways and gap.max() > self.error():
            chosen.append(int(pool[gap.argmax()]))
            gap = np.minimum(gap, self.near(x[pool], extra[pool], x[chosen[-1:]], extra[chosen[-1:]])[:, 0])
        return chosen

    def error(self) -> float:
        """How far a squared distance may be off by rounding."""
        return 1e-12 * (4 * self.top + 1)

    def near(self, x, extra, p, p_extra) -> np.ndarray:
        """Squared distances of lifted rows."""
        return np.maximum(0.0, 2 * self.top - 2 * (x.astype(np.float64) @ p.astype(np.float64).T + np.outer(extra, p_extra)))

    def route(self, x: np.ndarray) -> np.ndarray:
        leaf, extra = np.zeros(len(x), dtype=np.int64), self.lift(x)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                leaf[own] = ~node
            elif len(own):
                a, e = self.first[node], self.first[node + 1]
                near = self.near(x[own], extra[own], self.points[a:e], self.extra[a:e]).argmin(axis=1)
                todo += [(int(self.child[a + w]), own[near == w]) for w in range(e - a)]
        return leaf

    def spans(self, x: np.ndarray, leaf: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(point that leads to ``leaf``, least and largest squared distance of its node's points to the rows)."""
        out, extra = [], self.lift(x)
        for p in self.path[leaf]:
            a, e = self.first[self.node_of[p]], self.first[self.node_of[p] + 1]
            d = self.near(x, extra, self.points[a:e], self.extra[a:e])
            out.append((p, d.min(axis=0), d.max(axis=0)))
        return out

    def from_anchors(self, x: np.ndarray) -> np.ndarray:
        """Distances of anchors (no lift) to all split points."""
        return np.sqrt(np.maximum(0.0, (x.astype(np.float64) ** 2).sum(axis=1)[:, None] + self.top
                                  - 2 * x.astype(np.float64) @ self.points.astype(np.float64).T))

    def meets(self, d: np.ndarray, r1: np.ndarray, r2: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the ranges [low, high] (squared) of split points at distances ``d`` (anchors x points) can
        hold a row of each anchor's annulus [r1, r2], judged by all points."""
        slip = np.sqrt(self.error())
        lo, hi = np.sqrt(np.maximum(0.0, low - self.error())) - slip, np.sqrt(high + self.error()) + slip
        least = np.maximum(d - r2[:, None], r1[:, None] - d)
        return ((least <= hi) & (d + r2[:, None] >= lo)).all(axis=1)

    def leaves_for(self, x: np.ndarray, r1: np.ndarray, r2: np.ndarray) -> np.ndarray:
        """anchors x leaves: which leaves the stored ranges leave to each anchor."""
        d = self.from_anchors(x)
        out = np.zeros((len(x), len(self.path)), dtype=bool)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                out[own, ~node] = True
                continue
            a, e = self.first[node], self.first[node + 1]
            for w in range(e - a):
                low, high = self.low[a:e, w], self.high[a:e, w]
                if len(own) and np.isfinite(high).all():  # else no row lies there
                    left = own[self.meets(d[own, a:e], r1[own], r2[own], low, high)]
                    if len(left):
                        todo.append((int(self.child[a + w]), left))
        return out


def _radii(x: np.ndarray, top: float, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Annulus [r1, r2] that holds all rows with a score from ``low`` to ``high`` (r2 < 0: none)."""
    base = (x.astype(np.float64) ** 2).sum(axis=1) + top
    slip = 1e-9 * np.sqrt(base) + 1e-9
    r1 = np.sqrt(np.maximum(0.0, base - 2 * high.astype(np.float64))) - slip
    r2 = np.where(low <= high, np.sqrt(np.maximum(0.0, base - 2 * low.astype(np.float64))) + slip, -np.inf)
    return r1, r2


def _leaf_blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(leaf, ids, labels, matrix) blocks of rows of one leaf."""
    for b in batches:
        leaf = b.column(0).to_numpy(zero_copy_only=False)
        ids, label = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
        x = matrix(b.column(3), width)
        order = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(leaf[order]) != 0)) if len(leaf) else []
        for a, e in zip(cuts, np.append(cuts[1:], len(leaf))):
            for at in range(a, e, BLOCK):
                own = order[at:min(e, at + BLOCK)]
                yield int(leaf[own[0]]), ids[own], label[own], x[own]


def _search(shared, width: int, k: int, own_leaf_only: bool, same_label: bool):
    """Best ``k`` rows of each window of each anchor.  ``windows``: anchors x t score bounds (low, high)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, names, labels, x, low, high, allowed = shared.value
        t = low.shape[1]
        to_points = tree.from_anchors(x)
        best = Keeper(len(names) * t, k)
        for leaf, ids, label, rows in _leaf_blocks(batches, width):
            asked = np.flatnonzero(np.unpackbits(allowed[leaf], count=len(names)))
            if not len(asked):
                continue
            floor = best.floor.reshape(-1, t)[asked]
            least, largest = np.maximum(low[asked], floor), high[asked]
            some = least <= largest
            least_of = np.where(some, least, LONG).min(axis=1)
            largest_of = np.where(some, largest, LEAST).max(axis=1)
            if not own_leaf_only:
                r1, r2 = _radii(x[asked], tree.top, least_of, largest_of)
                live = r2 >= 0
                for p, near, far in tree.spans(rows, leaf):
                    n = tree.node_of[p]
                    live &= tree.meets(to_points[asked, tree.first[n]:tree.first[n + 1]], r1, r2, near, far)
                asked, least, largest = asked[live], least[live], largest[live]
                least_of, largest_of = least_of[live], largest_of[live]
            step = max(1, SCORES // len(rows))
            for at in range(0, len(asked), step):
                part = slice(at, at + step)
                score = inner(x[asked[part]], rows)
                fits = (label == labels[asked[part]][:, None]) == same_label
                fits &= (score >= least_of[part][:, None]) & (score <= largest_of[part][:, None])
                fits &= ids != names[asked[part]][:, None]
                a, v = np.nonzero(fits)
                for w in range(t):
                    s = score[a, v]
                    mine = (s >= least[part][a, w]) & (s <= largest[part][a, w])
                    best.add(asked[part][a[mine]] * t + w, s[mine], ids[v[mine]])
            best.settle()
        slot, score, vec = best.best()
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot // t, pa.int64()), pa.array(slot % t, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.int64())],
            names=["anchor", "win", "vec_id", "score"])

    return search


class _Index:
    """The table clustered by leaf, and searches of it for one slice of anchors."""

    def __init__(self, rows: DataFrame, scale: int, ways: int, sample_rows: int, leaf_rows: int) -> None:
        self.spark = spark = rows.sparkSession
        n, self.width, top, _, _ = survey(rows, scale)
        self.n = n
        if not n:
            return
        width = self.width
        share = min(1.0, 2 * sample_rows / n)
        picked = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < share * 1_000_003) \
            .orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vec_id", "v").toArrow()  # bounded by sample_rows
        _, sample = fixed_point(picked.column("v"), scale, width)
        self.tree = Tree(sample if len(sample) else np.zeros((1, width), dtype=np.int64), top, ways, leaf_rows)
        shared = spark.sparkContext.broadcast(self.tree)

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, BLOCK):
                    b = whole.slice(at, BLOCK)
                    own, x = fixed_point(b.column(1), scale, width)
                    take = pa.array(own, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shared.value.route(x), pa.int64()), b.column(0).take(take), b.column(2).take(take), lists(x)],
                        names=["leaf", "vec_id", "label", "x"])

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = shared.value
            low, high = np.full((len(tree.child), ways), np.inf), np.full((len(tree.child), ways), -np.inf)
            for leaf, _, _, x in _leaf_blocks(batches, width):
                for p, near, far in tree.spans(x, leaf):
                    a, e = tree.first[tree.node_of[p]], tree.first[tree.node_of[p] + 1]
                    low[a:e, p - a] = np.minimum(low[a:e, p - a], near)
                    high[a:e, p - a] = np.maximum(high[a:e, p - a], far)
            p, w = np.nonzero(np.isfinite(high))
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(w, pa.int64()), pa.array(low[p, w]), pa.array(high[p, w])],
                                             names=["p", "w", "low", "high"])

        self.rows = materialize(rows.mapInArrow(route, "leaf long, vec_id long, label long, x array<long>")
                                .repartitionByRange("leaf", "vec_id").sortWithinPartitions("leaf"), "gnat-rows")
        self.tree.low = np.full((len(self.tree.child), ways), np.inf)
        self.tree.high = np.full((len(self.tree.child), ways), -np.inf)
        found = self.rows.mapInArrow(ranges, "p long, w long, low double, high double") \
            .groupBy("p", "w").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()  # ways x ways a node
        p, w = found.column("p").to_numpy(), found.column("w").to_numpy()
        self.tree.low[p, w], self.tree.high[p, w] = found.column("low").to_numpy(), found.column("high").to_numpy()
        shared.unpersist()

    def search(self, names, labels, x, low, high, k: int, same_label: bool, own_leaf_only: bool = False) -> DataFrame:
        """anchor (its number), win, vec_id, score, r: each window's best k rows; windows are (low, high) scores."""
        if own_leaf_only:
            live = np.zeros((len(names), len(self.tree.path)), dtype=bool)
            live[np.arange(len(names)), self.tree.route(x)] = True
        else:
            some = low <= high
            r1, r2 = _radii(x, self.tree.top, np.where(some, low, LONG).min(axis=1), np.where(some, high, LEAST).max(axis=1))
            live = self.tree.leaves_for(x, r1, r2)
        shared = self.spark.sparkContext.broadcast((self.tree, names, labels, x, low, high, np.packbits(live.T, axis=1)))
        order = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "vec_id")
        return self.rows.mapInArrow(_search(shared, self.width, k, own_leaf_only, same_label),
                                    "anchor long, win long, vec_id long, score long") \
            .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)


def mine(vectors: DataFrame, *, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, anchors: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", ways: int = WAYS, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_SAMPLE,
         slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components count as floor(scale * x); a row's score is its inner product with the anchor, higher
    first, ties by smaller id.  ``anchors`` is a condition on ``vec_id`` (default: divisible by 100).  An
    anchor's positives are its first ``positives`` other rows with its label, and for each of them the
    first ``negatives`` rows of other labels with low * p <= 100 * s <= high * p are returned (all, if
    fewer; none for a negative p).

    Rows with a null id, label or vector or a null or non-finite component take no part.  Shorter
    vectors are filled with zeros.  Rows that repeat an id count each; rows with the anchor's id never
    count for it, and of several rows under an anchor's id the one with the smallest (label, vector) is the
    anchor.  Other columns are ignored; an empty table gives no rows.  A score beyond 64 bits raises
    ArithmeticError.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.col(label_col).cast("long").alias("label")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.col("label").isNotNull())
    index = _Index(rows, scale, ways, sample_rows, leaf_rows)
    if not index.n:
        return spark.createDataFrame([], schema)
    asked = materialize(index.rows.filter(every(ANCHOR_EVERY) if anchors is None else anchors)
                        .groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("a")).select("vec_id", "a.*"), "gnat-anchors")
    slices = max(1, -(-asked.count() * 8 * max(64, index.width) // slice_bytes))
    done = []
    for s in range(slices):
        part = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(slices)) == s).toArrow()  # about slice_bytes at most
        if not part.num_rows:
            continue
        names, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
        x = matrix(part.column("x"), index.width)
        done.append(_mine_slice(index, names, labels, x, positives, negatives, low, high, schema))
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], schema)


def _mine_slice(index: _Index, names, labels, x, positives: int, negatives: int, low: int, high: int, schema: str) -> DataFrame:
    spark, n = index.spark, len(names)
    least, largest = np.full((n, 1), LEAST), np.full((n, 1), LONG)
    near = index.search(names, labels, x, least, largest, positives, True, own_leaf_only=True) \
        .filter(F.col("r") == positives).select("anchor", "score").toArrow()  # one row an anchor of the slice
    least[near.column("anchor").to_numpy(), 0] = near.column("score").to_numpy()
    found = index.search(names, labels, x, least, largest, positives, True).select("anchor", "vec_id", "score", "r").toArrow()
    anchor, place = found.column("anchor").to_numpy(), found.column("r").to_numpy() - 1
    score = np.zeros((n, positives), dtype=np.int64)
    score[anchor, place] = found.column("score").to_numpy()
    from_, upto = np.full((n, positives), LONG), np.full((n, positives), LEAST)
    each = score[anchor, place]
    from_[anchor, place] = [-(-low * p // 100) for p in each.tolist()]
    upto[anchor, place] = [high * p // 100 for p in each.tolist()]
    pairs = spark.createDataFrame(pa.table({"anchor": pa.array(anchor, pa.int64()), "win": pa.array(place, pa.int64()),
                                            "anchor_id": pa.array(names[anchor], pa.int64()), "positive_id": found.column("vec_id"),
                                            "positive_score": pa.array(each, pa.int64())}))
    hard = index.search(names, labels, x, from_, upto, negatives, False)
    out = hard.join(F.broadcast(pairs), ["anchor", "win"]).select(  # positives of one slice
        "anchor_id", "positive_id", F.col("r").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
    return materialize(out, "gnat-slice")
