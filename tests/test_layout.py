"""Tables bucketed by user, rows that don't travel, tables written once."""

import random

import pytest

from cinerank.functions.vectors import dense_cosine, squared_norm
from cinerank.operators import prep
from cinerank.operators.content import excluded_in_own
from cinerank.operators.neighbors import _item_facts, _strips, strip_plan
from cinerank.operators.random_rec import draw_ranks, random_top_n
from cinerank.plans.pipeline import Recommender
from cinerank.session import materialize_by
from cinerank.sources.testdata import ratings_from_tables
from pyspark.sql import functions as F
from tests import oracle_py

VOCABULARY = ("A", "B", "C")


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def data(seed=4, users=40, items=30, rows=500):
    rng = random.Random(seed)
    pairs = sorted({(rng.randrange(users), rng.randrange(items)) for _ in range(rows)})
    ratings = [(u, i, rng.randrange(1, 11) / 2, rng.randrange(1000)) for u, i in pairs]
    catalog = [(i, f"t{i}", rng.choice(["A", "A|B", "C|B", "A|B|C", "(no genres listed)"])) for i in range(items + 5)]
    return ratings, catalog


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_view_is_dealt_by_user_once(spark):
    lineitem = spark.createDataFrame(
        [(1, 7, 1, 10.0), (2, 7, 1, 26.0), (2, 7, 2, 30.0), (2, 8, 1, 1.0), (3, 8, 1, 50.0)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double")
    orders = spark.createDataFrame([(1, 5, "1998-01-01"), (2, 5, "1998-01-01"), (3, None, "1997-01-01")],
                                   "o_orderkey long, o_custkey long, d string").select(
        "o_orderkey", "o_custkey", F.to_date("d").alias("o_orderdate"))
    view = ratings_from_tables(lineitem, orders)
    got = {(r.userId, r.movieId): r.rating for r in view.collect()}
    assert got == {(5, 7): 3.0, (5, 8): 0.5, (None, 8): 5.0}
    text = plan_of(view)
    assert "hashpartitioning(userId" in text
    assert not [x for x in text.splitlines() if "hashpartitioning(userId" in x and "movieId#" in x.split("hashpartitioning")[1].split(")")[0]]


def test_user_cut_needs_no_exchange(spark, frames, no_auto_broadcast):
    ratings, _ = data()
    out = prep.prepare_ratings(frames(ratings + [(None, 1, 4.0, 1), (3, 2, float("nan"), 1)])[0], cut_input=True)
    assert rows_of(out) == sorted(oracle_py.prepare(ratings))
    assert "hashpartitioning(userId" not in plan_of(out)


def test_item_cut_beyond_a_broadcast(spark, frames, monkeypatch, no_auto_broadcast):
    monkeypatch.setattr(prep, "fits_broadcast", lambda n: False)
    ratings, _ = data(seed=5)
    out = prep.prepare_ratings(frames(ratings)[0], cut_input=True)
    assert rows_of(out) == sorted(oracle_py.prepare(ratings))
    text = plan_of(out)  # the cut table was written by user
    assert "hashpartitioning(userId" not in text and "hashpartitioning(movieId" not in text


def test_neighbours_are_written_without_the_weight(spark, frames):
    ratings, catalog = data()
    rec = Recommender(*frames(ratings, catalog), prepared=True, k=5, vocabulary=VOCABULARY)
    assert "w" in rec.neighbors.columns
    assert "w" not in spark.read.parquet(*rec.neighbors.inputFiles()).columns


def test_strips_are_dealt_evenly(spark, frames):
    ratings, catalog = data(users=80, items=60, rows=1500)
    r, c = frames(ratings, catalog)
    facts = _item_facts(r, c)
    plan = strip_plan(facts, 2000)
    assert plan.strips > 10
    dealt = _strips(r, facts, plan, 1024, False, False).where("strip >= 0").select(F.spark_partition_id().alias("p"), "strip").distinct()
    assert dealt.groupBy("p").count().agg(F.max("count")).first()[0] == 1


def test_liked_ratings_and_profiles_are_computed_once(spark, frames):
    ratings, catalog = data()
    rec = Recommender(*frames(ratings, catalog), prepared=True, vocabulary=VOCABULARY)
    assert "Window" not in plan_of(rec.content.recent)
    universe = rec.content.item_sigs.select("movieId", "sig")
    found = rec.content.signatures_for(universe, rec.ratings.select("userId", "movieId"), 5)
    assert "MapInArrow" not in plan_of(found)


@pytest.mark.parametrize("small", [True, False])
def test_excluded_rows_of_own_signatures(spark, small):
    own = spark.createDataFrame([(1, "A"), (1, "B"), (2, "B")], "userId long, sig string")
    items = spark.createDataFrame([(10, "A"), (11, "B"), (12, "C")], "movieId long, sig string")
    excluded = spark.createDataFrame([(1, 10), (1, 10), (1, 12), (2, 10), (2, 11), (3, 11), (None, 11), (1, None)],
                                     "userId long, movieId long")
    assert rows_of(excluded_in_own(own, items, excluded, small)) == [(1, 10), (1, 10), (2, 11)]


def test_random_without_an_exchange_of_ratings(spark, frames, no_auto_broadcast):
    ratings, catalog = data()
    r, c = frames(ratings, catalog)
    by_user = materialize_by(r, "ratings", "userId")
    plain = random_top_n(r, c, 5, small_catalog=False)
    kept = random_top_n(by_user, c, 5, small_catalog=False, cut=True, clustered=True)
    assert rows_of(kept) == rows_of(plain)
    text = plan_of(kept)  # positions are broadcast, though rows of the catalog would not be
    assert "hashpartitioning(pos" not in text and "hashpartitioning(movieId" not in text


def test_draws_are_computed_once(spark):
    drawn = draw_ranks(spark.createDataFrame([(1, 9), (2, 3), (3, 0)], "userId long, n_unseen long"), 5, 42)
    assert {(r.userId, r.n) for r in drawn.groupBy("userId").agg(F.count_distinct("rank").alias("n")).collect()} == {(1, 5), (2, 3)}
    assert plan_of(drawn).count("md5") <= 2  # the projection and the generator's copy; no filter by the list's size


def test_cosine_with_given_norms(spark):
    df = spark.createDataFrame([([1.0, 2.5, 0.0], [0.0, 1.0, 1.0]), ([0.0] * 3, [1.0] * 3)], "a array<double>, b array<double>")
    both = df.withColumn("na", squared_norm("a")).withColumn("nb", squared_norm("b")).select(
        dense_cosine("a", "b").alias("x"), dense_cosine("a", "b", "na", "nb").alias("y")).collect()
    assert all(r.x == r.y for r in both)
