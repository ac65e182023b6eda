"""Exact top-k, hard negatives and centroid clustering against brute force."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from cinerank.llm import clusters, negatives, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, cluster string, leaf string, x string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, label, "s", "r", "c", "l", "x") for i, v, label in rows], SCHEMA).repartition(parts)


def usable(rows, scale):
    """(id, integers, label) of the vectors that take part, as float32 stores them."""
    out = []
    for i, v, label in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        out.append((i, [math.floor(scale * float(np.float32(c))) for c in v], label))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def asked(rows, n):
    """One row an id divisible by n: the smallest vector, filled with zeros."""
    width = max((len(v) for _, v, _ in rows), default=0)
    out = {}
    for i, v, label in rows:
        if i is not None and i % n == 0:
            out[i] = min(out.get(i, (label if label is not None else 0, v + [0] * (width - len(v)))),
                         (label if label is not None else 0, v + [0] * (width - len(v))))
    return out


def brute_top(rows, k, n):
    own = usable(rows, topk.SCALE)
    asks = {i: min(v + [0] * (99 - len(v)) for j, v, _ in own if j == i) for i, _, _ in own if i is not None and i % n == 0}
    out = []
    for q, x in asks.items():
        near = sorted((-dot(x, v), i) for i, v, _ in own if i is not None and i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def brute_negatives(rows, n):
    own = [(i, v, label) for i, v, label in usable(rows, negatives.SCALE) if i is not None and label is not None]
    out = []
    for q, (label, x) in asked(own, n).items():
        scored = sorted((-dot(x, v), i, other) for i, v, other in own if i != q)
        same = [(-s, i) for s, i, other in scored if other == label][:5]
        for p, i in same:
            fit = [(-s, j) for s, j, other in scored if other != label and 80 * p <= 100 * -s <= 100 * p][:5]
            out += [(q, i, r + 1, j, p, s) for r, (s, j) in enumerate(fit)]
    return sorted(out)


def brute_clusters(rows, k, rounds, dim):
    own = [(i, v) for i, v, _ in usable(rows, clusters.SCALE) if len(v) == dim]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in own if i is not None)[:k]
    centers = [v for _, v in start]
    if not centers:
        return []

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers)) for _, v in own]

    for _ in range(rounds):
        where = place()
        for j in range(len(centers)):
            mine = [v for (_, v), (_, c) in zip(own, where) if c == j]
            if mine:
                centers[j] = [sum(col) // len(mine) for col in zip(*mine)]
    where = place()
    per = {j: sum(d for d, c in where if c == j) for j in range(len(centers))}
    return sorted(((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(own, where)), key=repr)


def got_top(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def got_negatives(df):
    return sorted(tuple(r) for r in df.collect())


def noise(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    return [(int(i), (centers[i % 6] + spread * rng.normal(size=dim)).tolist(), int(i % 5)) for i in range(n)]


ODD = [(None, [1.0, 2.0], 1), (100, None, 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 2), (400, [float("inf"), 0.0], 1),
       (500, [], 1), (600, [0.0, 0.0], 1), (700, [1.5, -2.25], None), (700, [1.5, -2.25], 1), (700, [0.5, 3.0], 2), (1, [1.5, -2.25], 1),
       (1, [1.5, -2.25], 1), (2, [1.5], 2), (3, [0.25, 3.0], 2), (-100, [-1.0, 1.0], 2), (-7, [2.0, 1.0], 1), (14, [2.0, 1.0], 2),
       (15, [1.0, 1.0, 1.0], 1), (800, [1.0, 1.0], 1), (21, [1.25, 1.0], 2), (22, [1.0, 1.25], 1), (900, [1.0, 1.0], 1)]


@pytest.mark.parametrize("rows", [noise(1, 900, 8), ODD, noise(2, 60, 3) + ODD, [(100, [1.0], 1)], [(3, [1.0], 1), (4, [2.0], 1)]])
def test_top_k_equals_brute_force(spark, rows):
    assert got_top(topk.top_k(frame(spark, rows))) == brute_top(rows, topk.K, topk.QUERY_EVERY)


def test_top_k_in_many_slices_and_bins(spark):
    rows = noise(3, 500, 4)
    df = frame(spark, rows)
    assert got_top(topk.top_k(df, k=7, bins=3, slice_bytes=64, queries=(topk.F.col("vec_id") % 50 == 0))) == brute_top(rows, 7, 50)


def test_top_k_breaks_a_third_of_equal_rows_by_id(spark, monkeypatch):
    """Many equal scores at the k-th place: the search goes on over the ids, in several rounds."""
    rows = [(i, [1.0, 1.0] if i % 3 else [float(i % 7) / 16, 0.5], 0) for i in range(1200)]
    monkeypatch.setattr(topk, "SLACK", 0)
    assert got_top(topk.top_k(frame(spark, rows), bins=8)) == brute_top(rows, topk.K, topk.QUERY_EVERY)


def test_top_k_counts_fewer_pairs_than_it_scores(spark):
    """The histogram step narrows: the last pass keeps few more than k pairs a query."""
    rows = noise(4, 2000, 8)
    df = frame(spark, rows, 1).select("vec_id", topk.F.col("embedding").cast("array<double>").alias("v"))
    facts = vectors.survey(df, topk.SCALE)
    own = {i: v for i, v, _ in usable(rows, topk.SCALE)}
    ids = np.array([0, 100, 200])
    x = np.array([own[int(i)] for i in ids])
    limit, tie = topk._locate(df, ids, x, facts, 10, topk.SCALE, 64)
    for q, low, t in zip(ids, limit, tie):
        held = sum(dot(own[int(q)], v) > low or dot(own[int(q)], v) == low and ~i >= t for i, v in own.items() if i != q)
        assert 10 <= held <= 10 + topk.SLACK * 10


def test_large_components_stay_exact_or_fail(spark):
    big = 2.0 ** 24 + 1
    rows = [(0, [big * 64, 1.0], 0), (1, [big * 64, 0.5], 0), (2, [big * 64, 0.25], 0)]
    rows = [(i, [float(np.float32(c)) for c in v], label) for i, v, label in rows]
    assert got_top(topk.top_k(frame(spark, rows), scale=1)) == sorted(
        (0, r + 1, i, int(dot([math.floor(c) for c in rows[0][1]], [math.floor(c) for c in rows[i][1]]))) for r, i in enumerate([1, 2]))
    with pytest.raises(Exception, match="62 bits|64 bits"):
        topk.top_k(frame(spark, [(0, [3e38], 0), (1, [3e38], 0)])).collect()


@pytest.mark.parametrize("rows", [noise(5, 700, 6, 0.4), noise(6, 700, 8, 2.0), ODD, noise(7, 80, 2) + ODD, [(100, [1.0], 1)]])
def test_negatives_equal_brute_force(spark, rows):
    got = got_negatives(negatives.mine(frame(spark, rows), ways=3, leaf_rows=4))
    assert got == brute_negatives(rows, negatives.ANCHOR_EVERY)


def test_negatives_in_slices_with_a_hot_vector_and_ties(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "SCORES", 64)
    rows = noise(8, 600, 4, 0.5)
    rows = [(i, [1.0, 0.5, 0.0, 0.25] if i % 3 == 0 else v, i % 4) for i, v, _ in rows]
    got = got_negatives(negatives.mine(frame(spark, rows), slice_bytes=600, sample_rows=100, leaf_rows=8))
    assert got == brute_negatives(rows, negatives.ANCHOR_EVERY) and got


def test_tree_leaves_out_subtrees_but_none_that_holds_a_row_of_the_window(spark):
    rng = np.random.default_rng(9)
    centers = 4000 * rng.normal(size=(20, 6))
    x = np.floor(centers[np.arange(2000) % 20] + 100 * rng.normal(size=(2000, 6))).astype(np.int64)
    tree = negatives.Tree(x[::4], float((x.astype(float) ** 2).sum(axis=1).max()) * 1.001, 4, 16)
    leaf = tree.route(x)
    tree.low, tree.high = np.full((len(tree.child), 4), np.inf), np.full((len(tree.child), 4), -np.inf)
    for at in np.unique(leaf):
        for p, near, far in tree.spans(x[leaf == at], int(at)):
            a, e = tree.first[tree.node_of[p]], tree.first[tree.node_of[p] + 1]
            tree.low[a:e, p - a] = np.minimum(tree.low[a:e, p - a], near)
            tree.high[a:e, p - a] = np.maximum(tree.high[a:e, p - a], far)
    score = x[:20] @ x.T
    high = np.sort(score, axis=1)[:, -2]
    low = np.sort(score, axis=1)[:, -30]
    r1, r2 = negatives._radii(x[:20], tree.top, low, high)
    live = tree.leaves_for(x[:20], r1, r2)
    for a in range(20):
        assert live[a, leaf[(score[a] >= low[a]) & (score[a] <= high[a])]].all()
    assert live.mean() < 0.5


@pytest.mark.parametrize("k,rounds", [(5, 3), (40, 1)])
def test_clusters_equal_brute_force(spark, k, rounds):
    rows = noise(10, 300, 4, 0.7) + [(1000 + i, [0.5, 0.5, 0.5, 0.5], 0) for i in range(120)] + [
        (None, [1.0, 2.0, 3.0, 4.0], 1), (7, [1.0, 2.0, 3.0], 1), (8, None, 1), (9, [1.0, None, 2.0, 3.0], 1),
        (10, [float("nan"), 1.0, 1.0, 1.0], 1), (2, [9.0, 9.0, 9.0, 9.0], 1), (2, [9.0, 9.0, 9.0, 9.0], 1)]
    got = sorted((tuple(r) for r in clusters.cluster(frame(spark, rows), k=k, rounds=rounds, dim=4).collect()), key=repr)
    assert got == brute_clusters(rows, k, rounds, 4)


def test_few_vectors_and_empty_clusters(spark):
    rows = [(i, [float(i // 4)] * 2, 0) for i in range(6)]
    got = sorted((tuple(r) for r in clusters.cluster(frame(spark, rows), k=9, dim=2).collect()), key=repr)
    assert got == brute_clusters(rows, 9, clusters.ROUNDS, 2)
    assert clusters.cluster(frame(spark, [(None, [1.0, 2.0], 0)]), dim=2).collect() == []


def test_ptolemaic_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(12)
    centers = np.floor(2000 * rng.normal(size=(30, 3))).astype(np.int64)
    x = np.floor(centers[rng.integers(0, 30, 4000)] + 40 * rng.normal(size=(4000, 3))).astype(np.int64)
    fixed = clusters.Pivots(centers[:6])
    dx = fixed.distances(x)
    bound = fixed.bounds(dx, fixed.distances(centers))
    true = clusters.squared_all(x, centers)
    assert (bound <= np.sqrt(true.astype(float))).all()
    near, best, taken = clusters.assign(x, dx, centers, fixed)
    assert (near == true.argmin(axis=1)).all() and (best == true.min(axis=1)).all()
    assert taken < 0.2 * true.size


@pytest.mark.parametrize("call", [topk.top_k, negatives.mine, clusters.cluster])
def test_empty_tables(spark, call):
    df = frame(spark, [(1, [1.0] * 64, 1)])
    want = call(df).columns
    for empty in (df.limit(0), frame(spark, [(1, None, 1), (0, [None], 1)])):
        assert call(empty).collect() == [] and call(empty).columns == want


def test_fixed_point_reads_slices_and_ragged_rows():
    col = pa.array([[9.0], [0.5, -0.25], None, [1.0], [], [None], [2.0, 3.0, 4.0]], pa.list_(pa.float64())).slice(1)
    rows, x = vectors.fixed_point(col, 4)
    assert rows.tolist() == [0, 2, 3, 5] and x.tolist() == [[2, -1, 0], [4, 0, 0], [0, 0, 0], [8, 12, 16]]


def test_keeper_is_bounded_and_exact():
    rng = np.random.default_rng(15)
    keep, all_ = vectors.Keeper(5, 3, limit=50), []
    for _ in range(40):
        slot, score, ids = rng.integers(0, 5, 30), rng.integers(-9, 9, 30), rng.integers(0, 50, 30)
        keep.add(slot, score, ids)
        all_ += list(zip(slot.tolist(), (-score).tolist(), ids.tolist()))
        assert keep.held <= 50 + 30
    want = [x for s in range(5) for x in sorted(y for y in all_ if y[0] == s)[:3]]
    assert list(zip(*(c.tolist() for c in keep.best()))) == [(s, -n, i) for s, n, i in want]
