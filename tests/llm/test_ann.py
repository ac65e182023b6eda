"""Projection-tree search against brute force."""

import numpy as np
import pytest

from cinerank.llm import ann


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")


def brute(rows, k):
    own = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        own[i] = np.array(v, dtype=np.float32).astype(float)
    out = {}
    for q in own:
        if q % 20 == 0:
            near = sorted(((-float((own[q] * v).sum()), i) for i, v in own.items() if i != q))[:k]
            out[q] = [i for _, i in near]
    return out


def recall(got, want):
    hits = sum(len(set(want[q]) & {r.vec_id for r in got if r.query_id == q}) for q in want)
    return hits / max(1, sum(map(len, want.values())))


def test_recall_order_and_exact_scores(spark):
    rng = np.random.default_rng(13)
    centers = rng.normal(size=(12, 24))
    rows = [(i, (centers[i % 12] + 0.6 * rng.normal(size=24)).tolist(), 0, "x") for i in range(3000)]
    got = ann.nearest(frame(spark, rows)).collect()
    want = brute(rows, ann.K)
    assert recall(got, want) >= 0.9
    x = {i: np.array(v, dtype=np.float32).astype(float) for i, v, *_ in rows}
    for q in list(want)[:20]:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, ann.K + 1))
        assert all(r.vec_id != q and r.score == float((x[q] * x[r.vec_id]).sum()) for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)


def test_small_table_edge_cases(spark):
    one = [1.0, 0.0, 2.0]
    rows = [(0, one, 0, "x"), (1, one, 0, "x"), (2, one, 0, "x"), (3, [0.0, 1.0, 0.0], 0, "x"), (4, None, 0, "x"),
            (5, [0.0, 0.0, 0.0], 0, "x"), (6, [1.0, None, 0.0], 0, "x"), (7, [float("nan"), 1.0, 0.0], 0, "x"),
            (8, [float("inf"), 1.0, 0.0], 0, "x"), (None, one, 0, "x"), (9, [1.0, 2.0], 0, "x"), (10, [], 0, "x"),
            (20, [5.0, 0.0, 1.0], 0, "x"), (20, [5.0, 0.0, 1.0], 0, "x"), (40, [0.0, 0.0, 0.0], 0, "x")]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(frame(spark, rows)).collect())
    assert got == [(0, 1, 20, 7.0), (0, 2, 1, 5.0), (0, 3, 2, 5.0), (0, 4, 3, 0.0),
                   (20, 1, 0, 7.0), (20, 2, 1, 7.0), (20, 3, 2, 7.0), (20, 4, 3, 0.0)]


@pytest.mark.parametrize("rows", [[], [(1, None, 0, "x")], [(20, [1.0, 0.0], 0, "x")], [(3, [1.0], 0, "x"), (4, [2.0], 0, "x")]])
def test_nothing_to_find(spark, rows):
    assert ann.nearest(frame(spark, rows)).collect() == []


def test_hot_vector_is_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP_ROWS", 40)
    monkeypatch.setattr(ann, "GROUP_QUERIES", 5)
    rng = np.random.default_rng(14)
    rows = [(i, [1.0, 1.0, 0.0, 0.0] if i % 3 else rng.normal(size=4).tolist(), 0, "x") for i in range(900)]
    got = ann.nearest(frame(spark, rows), k=5).collect()
    want = brute(rows, 5)
    by = {q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] for q in want}
    hot = [q for q in want if q % 3]
    assert all(len(by[q]) == 5 for q in want)
    assert np.mean([len(set(by[q]) & set(want[q])) / 5 for q in want]) >= 0.9 and hot
