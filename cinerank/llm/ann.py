"""Approximate nearest neighbours: a forest of random-projection trees, one shared priority queue.

Nearness is the inner product.  Vectors are scaled by the largest norm and get one more
component that fills them to length one, so the largest inner product is the nearest direction;
trees split by the hyperplane between two random sample vectors at the median.

* The forest is fitted on a bounded sample (``sample_rows``, by id hash) and shared with the tasks;
  every vector is indexed: routed through all trees, one row per tree.
* A query walks all trees through one priority queue (largest margin first) until
  ``leaf_budget`` leaves are visited.  By default the budget is measured: for a bounded set of
  sample queries the exact neighbours are found by brute force over all rows, and the budget is
  the one at which ``target`` of them lie in a visited leaf.
* Index rows and visits meet by (tree, leaf group); groups hold about ``GROUP_ROWS`` vectors, and a
  group with more vectors or more visiting queries (a frequent vector, say) is split on both
  sides by salts.  Each meeting gives the best ``k`` of its visited leaves, scored exactly on the
  original vectors; the best of those over all trees are the answer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.session import materialize

TREES = 8
SAMPLE_ROWS = 20_000
LEAF_ROWS = 48
GROUP_ROWS = 8192
GROUP_QUERIES = 2048
CALIBRATION_QUERIES = 96
TARGET = 0.965
K = 20


class Forest:
    """Random-projection trees over a sample of unit vectors, as flat arrays."""

    def __init__(self, sample: np.ndarray, trees: int, leaf_rows: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.planes: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.left: list[int] = []  # child: a node, or ~leaf
        self.right: list[int] = []
        self.roots: list[int] = []
        self.tree_of: list[int] = []  # of each leaf
        for t in range(trees):
            self.roots.append(self._grow(sample, np.arange(len(sample)), leaf_rows, rng, t))
        self.plane = np.stack(self.planes) if self.planes else np.zeros((0, sample.shape[1]))
        self.cut = np.array(self.cuts)
        self.leaves = [self.tree_of.count(t) for t in range(trees)]
        self.first_leaf = np.concatenate([[0], np.cumsum(self.leaves)])

    def _grow(self, x: np.ndarray, own: np.ndarray, leaf_rows: int, rng, tree: int) -> int:
        if len(own) > leaf_rows:
            for _ in range(4):
                a, b = x[rng.choice(own, 2, replace=False)]
                size = np.linalg.norm(a - b)
                if size > 1e-9:
                    w = (a - b) / size
                    p = x[own] @ w
                    cut = float(np.median(p))
                    low = p < cut
                    if low.any() and not low.all():
                        node = len(self.planes)
                        self.planes.append(w)
                        self.cuts.append(cut)
                        self.left.append(0)
                        self.right.append(0)
                        self.left[node] = self._grow(x, own[low], leaf_rows, rng, tree)
                        self.right[node] = self._grow(x, own[~low], leaf_rows, rng, tree)
                        return node
        self.tree_of.append(tree)
        return ~(len(self.tree_of) - 1)

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree (rows x trees)."""
        out = np.empty((len(x), len(self.roots)), dtype=np.int64)
        for t, root in enumerate(self.roots):
            todo = [(root, np.arange(len(x)))]
            while todo:
                node, own = todo.pop()
                if not len(own):
                    continue
                if node < 0:
                    out[own, t] = ~node
                    continue
                low = x[own] @ self.plane[node] < self.cut[node]
                todo += [(self.left[node], own[low]), (self.right[node], own[~low])]
        return out

    def visit(self, q: np.ndarray, budget: int) -> list[int]:
        """The first ``budget`` leaves of all trees in the shared queue's order."""
        margin = (self.plane @ q - self.cut).tolist()
        heap = [(-np.inf, r) for r in self.roots]
        heapq.heapify(heap)
        out: list[int] = []
        while heap and len(out) < budget:
            cost, node = heapq.heappop(heap)
            while node >= 0:  # walk down the near side, queue the far side
                m = margin[node]
                near, far = (self.right[node], self.left[node]) if m >= 0 else (self.left[node], self.right[node])
                heapq.heappush(heap, (max(cost, abs(m)), far))
                node = near
            out.append(~node)
        return out


def _unit(x: np.ndarray, most: float) -> np.ndarray:
    x = x / most
    rest = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1, keepdims=True)))
    return np.concatenate([x, rest], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    """A dense float64 matrix of a list column whose rows have one length."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the same for equal rows."""
    return np.multiply(x, q).sum(axis=1)


def best_of(ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: int, k: int, rough: np.ndarray) -> tuple:
    """(ids, exact scores) of the k nearest by (score descending, id), given rough scores."""
    real = ids != own
    ids, x, rough = ids[real], x[real], rough[real]
    if len(ids) > k:
        last = np.partition(rough, len(rough) - k)[len(rough) - k]
        close = rough >= last - 1e-9 * max(1.0, abs(last))
        ids, x = ids[close], x[close]
    score = exact_scores(x, q)
    top = np.lexsort((ids, -score))[:k]
    return ids[top], score[top]


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v double[]) without null, empty, zero or non-finite vectors and null ids.

    Vectors of another length than the most frequent one (ties: the longer) take no part either.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                & F.exists(v, lambda c: c != 0))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("v") == (length[0].d if length else 0))


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", queries=None, k: int = K,
            trees: int = TREES, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS,
            leaf_budget: int | None = None, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's ``k`` nearest other rows.

    ``queries`` is a condition on ``vec_id`` (default: divisible by 20).  Null, empty, zero and
    non-finite vectors, null ids and vectors of an unusual length take no part.  Score ties go to
    the smaller id; a query gets all candidates found if they are fewer than ``k`` (all rows, if
    the table is that small).  Rows that repeat an id and a vector count once; an id with several
    vectors keeps each as a candidate by its best score.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    own = valid_vectors(vectors, id_col, vector_col)
    is_query = F.pmod(F.col("vec_id"), F.lit(20)) == 0 if queries is None else queries
    facts = own.agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("sqrt(aggregate(v, 0D, (a, x) -> a + x * x))")).alias("m"),
                    F.count_if(is_query).alias("q")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not facts.n:
        return spark.createDataFrame([], schema)
    n, most, n_queries = int(facts.n), float(facts.m), int(facts.q)
    share = min(1.0, sample_rows / n)
    sample = own.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < share * 1_000_003) \
        .orderBy(F.xxhash64("vec_id")).limit(sample_rows).toPandas()  # bounded by sample_rows
    if sample.empty:
        sample = own.limit(sample_rows).toPandas()
    forest = Forest(_unit(np.stack(sample["v"].to_numpy()).astype(np.float64), most), trees, leaf_rows)
    shared = spark.sparkContext.broadcast((forest, most))
    if leaf_budget is None:
        leaf_budget = _calibrate(own, is_query, forest, most, n_queries, k, target)
    groups = [max(1, min(leaves, -(-n // GROUP_ROWS))) for leaves in forest.leaves]

    def group_of(leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tree = np.searchsorted(forest.first_leaf, leaf, "right") - 1
        return tree, (leaf - forest.first_leaf[tree]) * np.array(groups)[tree] // np.array(forest.leaves)[tree]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, top = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                leaf = f.route(_unit(_matrix(b.column(1)), top))
                for t in range(leaf.shape[1]):
                    tree, group = group_of(leaf[:, t])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tree, pa.int32()), pa.array(group, pa.int32()), pa.array(leaf[:, t]), b.column(0),
                         b.column(1)], names=["tree", "grp", "leaf", "vec_id", "v"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, top = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                x = _matrix(b.column(1))
                q = np.concatenate([x / np.sqrt((x * x).sum(axis=1, keepdims=True)), np.zeros((len(x), 1))], axis=1)
                row, tree, grp, leaves = [], [], [], []
                for i in range(len(q)):
                    leaf = np.sort(np.array(f.visit(q[i], leaf_budget), dtype=np.int64))
                    t, g = group_of(leaf)
                    cut = np.flatnonzero(np.append(True, (np.diff(t) != 0) | (np.diff(g) != 0)))
                    for a, e in zip(cut, np.append(cut[1:], len(leaf))):
                        row.append(i)
                        tree.append(t[a])
                        grp.append(g[a])
                        leaves.append(leaf[a:e])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree, pa.int32()), pa.array(grp, pa.int32()), b.column(0).take(pa.array(row, pa.int64())),
                     b.column(1).take(pa.array(row, pa.int64())), pa.array(leaves, pa.list_(pa.int64()))],
                    names=["tree", "grp", "query_id", "q", "leaves"])

    indexed = own.mapInArrow(index, "tree int, grp int, leaf long, vec_id long, v array<double>")
    visited = own.filter(is_query).distinct().mapInArrow(
        visits, "tree int, grp int, query_id long, q array<double>, leaves array<long>")
    indexed, visited = materialize(indexed, "ann-index"), materialize(visited, "ann-visits")
    parts = indexed.groupBy("tree", "grp").agg(F.ceil(F.count(F.lit(1)) / (2 * GROUP_ROWS)).cast("int").alias("p")) \
        .join(visited.groupBy("tree", "grp").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).cast("int").alias("qp")),
              ["tree", "grp"])
    spread = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = indexed.join(parts, ["tree", "grp"]).withColumn("s", F.pmod(F.xxhash64("vec_id"), F.col("p")).cast("int")) \
        .withColumn("t", spread("qp")).drop("p", "qp")
    right = visited.join(parts, ["tree", "grp"]).withColumn("t", F.pmod(F.xxhash64("query_id"), F.col("qp")).cast("int")) \
        .withColumn("s", spread("p")).drop("p", "qp")

    def meet(vecs: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if vecs.num_rows and asks.num_rows:
            x, leaf = _matrix(vecs.column("v").combine_chunks()), vecs.column("leaf").to_numpy()
            ids, q = vecs.column("vec_id").to_numpy(), _matrix(asks.column("q").combine_chunks())
            low = int(leaf.min())
            for at in range(0, len(q), 256):
                rough = q[at:at + 256] @ x.T
                for i, (query, leaves) in enumerate(zip(asks.column("query_id")[at:at + 256].to_pylist(),
                                                        asks.column("leaves")[at:at + 256])):
                    seen = np.zeros(int(leaf.max()) - low + 1, dtype=bool)
                    wanted = leaves.values.to_numpy() - low
                    seen[wanted[(wanted >= 0) & (wanted < len(seen))]] = True
                    in_ = np.flatnonzero(seen[leaf - low])
                    if len(in_) > 4 * k:  # the k nearest and their ties, before anything is copied
                        r = rough[i][in_]
                        last = np.partition(r, len(r) - k - 1)[len(r) - k - 1]
                        in_ = in_[r >= last - 1e-9 * max(1.0, abs(last))]
                    got, score = best_of(ids[in_], x[in_], q[at + i], query, k, rough[i][in_])
                    if len(got):
                        out.append((query, got, score))
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "ids": pa.array(cols[1], pa.list_(pa.int64())),
                         "scores": pa.array(cols[2], pa.list_(pa.float64()))})

    def merge(t: pa.Table) -> pa.Table:
        """A query's best over all meetings (at most k from each group it visits)."""
        best: dict[int, float] = {}
        for ids, scores in zip(t.column("ids").to_pylist(), t.column("scores").to_pylist()):
            for v, score in zip(ids, scores):
                if score > best.get(v, -np.inf):
                    best[v] = score
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        return pa.table({"query_id": pa.array([t.column("query_id")[0].as_py()] * len(top), pa.int64()),
                         "rank": pa.array(range(1, len(top) + 1), pa.int32()),
                         "vec_id": pa.array([v for v, _ in top], pa.int64()),
                         "score": pa.array([x for _, x in top], pa.float64())})

    key = ["tree", "grp", "s", "t"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        meet, "query_id long, ids array<long>, scores array<double>")
    return found.groupBy("query_id").applyInArrow(merge, schema)


def _calibrate(own: DataFrame, is_query, forest: Forest, most: float, n_queries: int, k: int, target: float) -> int:
    """Leaves to visit so that ``target`` of the true neighbours of sample queries are in a visited leaf."""
    spark = own.sparkSession
    share = min(1.0, 2 * CALIBRATION_QUERIES / max(1, n_queries))
    picked = own.filter(is_query & (F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_003)) < share * 1_000_003)) \
        .orderBy(F.xxhash64("vec_id")).limit(CALIBRATION_QUERIES).collect()
    total = len(forest.tree_of)
    if not picked:
        return total
    ids = [r.vec_id for r in picked]
    q = np.array([r.v for r in picked], dtype=np.float64)
    shared = spark.sparkContext.broadcast((ids, q))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked = shared.value
        for b in batches:
            x, vec = _matrix(b.column(1)), b.column(0).to_numpy()
            rough = asked @ x.T
            out: list[tuple] = []
            for i, query in enumerate(names):
                at = np.argpartition(-rough[i], min(k, len(vec) - 1))[:k + 1] if len(vec) > k + 1 else np.arange(len(vec))
                got, score = best_of(vec[at], x[at], asked[i], query, k, rough[i][at])
                by = {int(v): j for j, v in zip(at, vec[at])}
                out += [(query, int(v), float(s), x[by[int(v)]].tolist()) for v, s in zip(got, score)]
            cols = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
                 pa.array(cols[3], pa.list_(pa.float64()))], names=["query_id", "vec_id", "score", "v"])

    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = own.mapInArrow(brute, "query_id long, vec_id long, score double, v array<double>") \
        .withColumn("r", F.row_number().over(place)).filter(F.col("r") <= k).collect()  # k rows a sample query
    if not true:
        return total
    leaf = forest.route(_unit(np.array([r.v for r in true], dtype=np.float64), most))
    unit = q / np.sqrt((q * q).sum(axis=1, keepdims=True))
    when: dict[int, np.ndarray] = {}
    for i, query in enumerate(ids):
        order = np.full(total, total, dtype=np.int64)
        visit = forest.visit(np.append(unit[i], 0.0), total)
        order[visit] = np.arange(len(visit))
        when[query] = order
    needed = [int(when[r.query_id][leaf[j]].min()) + 1 for j, r in enumerate(true)]
    return int(np.quantile(needed, target, method="higher"))
