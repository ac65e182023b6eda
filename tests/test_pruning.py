"""Neighbour strips, the signature search and split joins: same rows, far fewer of them on the way."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.functions.genres import NO_GENRES
from cinerank.operators import content, joins
from cinerank.operators.item_based import item_based_scores
from cinerank.operators.neighbors import _item_facts, item_neighbors, pair_dots, strip_lists
from cinerank.plans.pipeline import Recommender
from tests import oracle_py


def ratings(seed, n_users, n_items, per_user, hot_item=0.5, hot_user=True):
    """One item in about half of the users' lists, one user with every item."""
    rng = random.Random(seed)
    rows = []
    for u in range(1, n_users + 1):
        own = set(rng.sample(range(2, n_items + 1), rng.randint(1, per_user))) | ({1} if rng.random() < hot_item else set())
        if u == 1 and hot_user:
            own = set(range(1, n_items + 1))
        rows += [(u, m, rng.randint(0, 10) / 2, rng.randint(0, 6) * 86400) for m in own]
    return rows


def catalog_of(n_items, step=1):
    return [(m, f"t{m}", "A" if m % 3 else NO_GENRES) for m in range(1, n_items + 1, step)]


def lists_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r.movieId, []).append((r.rnk, r.w, r.neighborId))
    return {i: [(w, j) for _, w, j in sorted(v)] for i, v in out.items()}


@pytest.mark.parametrize("strip_pairs", [10**9, 700, 60])
@pytest.mark.parametrize("block", [1024, 7])
@pytest.mark.parametrize("cut", [True, False])
def test_strips_equal_the_python_statement(frames, strip_pairs, block, cut):
    rows, catalog = ratings(1, 40, 30, 8), catalog_of(30, 1) + [(900, "unrated", "A")]
    catalog = [c for c in catalog if c[0] % 5]  # some rated items are not in the catalog
    r, c = frames(rows, catalog)
    got = item_neighbors(r, c, k=6, strip_pairs=strip_pairs, block_size=block, cut=cut)
    assert lists_of(got.collect()) == oracle_py.neighbors(rows, catalog, 6)


def test_no_pair_becomes_a_row(frames):
    """Rows on the way to the neighbours: lists per user and strip, then K per item; not the co-rated pairs."""
    rows = ratings(2, 60, 150, 60, hot_user=False)
    r, c = frames(rows, catalog_of(150))
    pairs = pair_dots(r).count()
    facts = _item_facts(r, c)
    lists = strip_lists(r, facts, 40_000, 1024, True)
    assert facts.agg(F.max("work")).first()[0] <= 40_000
    nb = item_neighbors(r, c, k=5, strip_pairs=40_000)
    assert nb.count() == 150 * 5
    assert lists.count() < 0.05 * pairs and nb.count() < 0.1 * pairs


def test_strips_of_an_empty_table(frames):
    r, c = frames([], catalog_of(3))
    assert item_neighbors(r, c).collect() == []


def test_signature_search_finds_all_needed_levels_and_skips_lengths():
    rng = np.random.default_rng(3)
    vocab = [f"g{i}" for i in range(30)]
    sigs = {"|".join(sorted(rng.choice(vocab, rng.integers(1, 9), replace=False))) for _ in range(600)}
    index = content.SignatureIndex.__new__(content.SignatureIndex)
    rows = sorted((s, int(rng.integers(1, 9))) for s in sigs)

    class Table:
        def collect(self):
            return [type("R", (), {"sig": s, "size": n}) for s, n in rows]

    index.__init__(Table(), vocab)
    pvec = np.where(rng.random((200, 30)) < 0.12, rng.integers(1, 40, (200, 30)) / 2, 0.0)
    pvec[:, 0] = np.maximum(pvec[:, 0], 0.5)
    need = rng.integers(1, 9, 200)
    need[:3] = 10**6  # all positive signatures
    p, s, value, better, taken = content.search_signatures(pvec, need, index)
    got = sorted(zip(p.tolist(), (index.names[i] for i in s), value.tolist(), better.tolist()))
    want = []
    for i, w in enumerate(pvec):
        p2 = float((w * w).sum())
        scored = []
        for sig, size in rows:
            on = [vocab.index(g) for g in sig.split("|")]
            c = int(np.floor(5.0 * float(w[on].sum()) / (np.sqrt(p2) * np.sqrt(float(len(on)))) * 1e6 + 0.5))
            if c > 0:
                scored.append((c, sig, size))
        for c, sig, size in scored:
            above = sum(n for x, _, n in scored if x > c)
            if above < need[i]:
                want.append((i, sig, c, above))
    assert got == sorted(want)
    assert taken < 0.8 * len(pvec) * len(rows)


def test_signature_search_without_signatures():
    empty = content.SignatureIndex.__new__(content.SignatureIndex)
    empty.__init__(type("T", (), {"collect": lambda self: []})(), ["a", "b"])
    out = content.search_signatures(np.ones((3, 2)), np.array([5, 5, 5]), empty)
    assert [len(x) for x in out[:4]] == [0, 0, 0, 0]


def test_content_rows_are_far_fewer_than_users_times_signatures(frames):
    rng = random.Random(4)
    vocab = [f"g{i}" for i in range(12)]
    catalog = [(m, f"t{m}", "|".join(rng.sample(vocab, 3))) for m in range(1, 301)]
    rows = [(u, m, 4.0, u * m % 7) for u in range(1, 81) for m in rng.sample(range(1, 301), 6)]
    r, c = frames(rows, catalog)
    rec = Recommender(r, c, prepared=True, vocabulary=vocab)
    universe = rec.content.item_sigs.select("movieId", "sig")
    few = rec.content.signatures_for(universe, rec.ratings, 5)
    every = content.user_signature_scores(rec.content.profile, rec.content.item_sigs)
    assert few.count() < 0.35 * every.count()
    keep = few.join(every.withColumnRenamed("c_micro", "c"), ["userId", "sig"])
    assert keep.where("c_micro <> c").count() == 0 and keep.count() == few.count()


@pytest.mark.parametrize("part_rows", [10**6, 40, 7])
def test_split_join_equals_join(spark, part_rows):
    rng = random.Random(5)
    left = spark.createDataFrame([(i, 1 if rng.random() < 0.6 else rng.randint(2, 30)) for i in range(500)], "a long, k long")
    right = spark.createDataFrame([(i, 1 if rng.random() < 0.3 else rng.randint(2, 40)) for i in range(200)], "b long, k long")
    cols = ["k", "a", "b"]
    got = joins.split_join(left, right, "k", part_rows)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, left.join(right, "k").select(*cols).collect()))


def test_scores_with_one_id_in_most_ratings_and_no_broadcast(frames, monkeypatch):
    rows = ratings(6, 50, 25, 6, hot_item=0.95)
    r, c = frames(rows, catalog_of(25))
    nb = item_neighbors(r, c, k=4)
    want = sorted(map(tuple, item_based_scores(r, nb, True).collect()))
    assert sorted(map(tuple, item_based_scores(r, nb, False, part_rows=10).collect())) == want
    monkeypatch.setattr(joins, "BROADCAST_BYTE_LIMIT", 0)
    assert sorted(map(tuple, item_based_scores(r, nb, part_rows=10).collect())) == want


def test_prepared_ratings_are_read_by_user_without_an_exchange(frames):
    rows = ratings(7, 60, 40, 9)
    r, c = frames(rows, catalog_of(40))
    rec = Recommender(r, c, prepared=True, k=5, vocabulary=("A",))
    plain = Recommender(r, c, prepared=True, k=5, vocabulary=("A",), cut_lineage=False)
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(userId")
    counts = rec.ratings.groupBy("userId").count()
    assert exchanges(counts) == 0 and exchanges(plain.ratings.groupBy("userId").count()) > 0
    scores = item_based_scores(rec.ratings, rec.neighbors, True, clustered=rec.clustered)
    assert exchanges(scores) == 0
    want = item_based_scores(plain.ratings, plain.neighbors, True)
    assert exchanges(want) > 0
    assert sorted(map(tuple, scores.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, rec.ratings.collect())) == sorted(map(tuple, r.collect()))


def test_cleanup_drops_bucketed_tables(spark):
    from cinerank.session import _TABLES, cleanup, materialize_by
    cleanup(spark)
    df = materialize_by(spark.range(20).withColumnRenamed("id", "userId"), "probe", "userId", 3)
    assert df.count() == 20
    table = _TABLES[spark.sparkContext.applicationId][0]
    assert cleanup(spark) == 1 and not spark.catalog.tableExists(table)
