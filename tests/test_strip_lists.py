"""Lists of strips: few bytes an entry, norms apart or with the entries, no join of the ratings."""

import pytest
from pyspark.sql import functions as F

from cinerank.operators import neighbors
from tests.test_pruning import catalog_of, ratings


def test_ratings_meet_no_facts_of_items_on_their_way_to_the_strips(frames):
    rows = ratings(2, 400, 300, 60, hot_user=False)
    r, c = frames(rows, catalog_of(300))
    facts = neighbors._item_facts(r, c)
    lists = neighbors.strip_lists(r, facts, 10**6, 1024, True)
    assert "Join" not in lists._jdf.queryExecution().executedPlan().toString()
    plan = neighbors.strip_plan(facts, 10**9)
    assert plan.strips == 1 and plan.norms_apart
    assert neighbors.strip_lists(r, facts, 0, 1024, True, plan).agg(F.sum(F.length("lists"))).first()[0] < 2.5 * len(rows)


@pytest.mark.parametrize("strip_pairs,block,share", [(10**9, 1024, 100), (60, 1024, 100), (60, 5, 100), (60, 5, 0), (400, 1024, 0)])
def test_items_outside_the_catalog_are_partners_only(frames, monkeypatch, strip_pairs, block, share):
    monkeypatch.setattr(neighbors, "NORM_SHARE", share)
    rows = ratings(9, 30, 24, 6)
    r, c = frames(rows, catalog_of(10))
    got = {(x.movieId, x.neighborId): x.sim for x in neighbors.item_neighbors(r, c, 50, block, True, strip_pairs).collect()}
    every = {}
    for x in neighbors.pair_similarities(r, block, True, strip_pairs).collect():
        every[x.i, x.j] = every[x.j, x.i] = x.sim
    assert got == {p: v for p, v in every.items() if p[0] <= 10} and any(j > 10 for _, j in got)
