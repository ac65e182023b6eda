"""Registered queries over the ratings/catalog view of the test tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.columns import from_micro, micro
from cinerank.functions.genres import TEST_VIEW_GENRES, multi_hot
from cinerank.functions.vectors import dense_cosine, squared_norm
from cinerank.operators import prep
from cinerank.operators.content import item_genres, item_signatures
from cinerank.operators.indexing import dense_index
from cinerank.operators.item_based import item_based_scores
from cinerank.operators.joins import ITEM_ROW, fits_broadcast, maybe_broadcast
from cinerank.operators.neighbors import item_norms, pair_dots, pair_similarities
from cinerank.operators.rank import flat_view, nested_view, rated_catalog_items, seen_pairs
from cinerank.operators.seen import seen_blocks, unseen_counts
from cinerank.plans.pipeline import Recommender, run_all
from cinerank.session import materialize
from cinerank.sources.testdata import catalog_view, ratings_view

N = 5
M = 5
K = 100


def _recommender(spark: SparkSession, sf_dir: str) -> Recommender:
    return Recommender(ratings_view(spark, sf_dir), catalog_view(spark, sf_dir), k=K,
                       vocabulary=TEST_VIEW_GENRES, on_unknown="error")


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(prep.prepare_ratings(ratings_view(spark, sf_dir), cut_input=True), "prepared")


def q_ratings_view(spark, sf_dir):
    return ratings_view(spark, sf_dir)


def q_catalog_genres(spark, sf_dir):
    return item_genres(item_signatures(catalog_view(spark, sf_dir), TEST_VIEW_GENRES, "error"))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rating view, written once: the cuts read it several times."""
    return materialize(prep.drop_incomplete(ratings_view(spark, sf_dir)), "ratings")


def q_activity_threshold(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    by_item = prep.remove_low_activity(clean, "movieId")
    items = prep.quartile_threshold(prep.key_counts(clean, "movieId")).select(
        F.lit("movieId").alias("key_kind"), "n_keys", "threshold")
    users = prep.quartile_threshold(prep.key_counts(by_item, "userId")).select(
        F.lit("userId").alias("key_kind"), "n_keys", "threshold")
    return items.unionByName(users)


def q_filter_low_activity_items(spark, sf_dir):
    return prep.remove_low_activity(_clean(spark, sf_dir), "movieId")


def q_filter_low_activity_users(spark, sf_dir):
    return prep.remove_low_activity(q_filter_low_activity_items(spark, sf_dir), "userId")


def q_high_rating_filter(spark, sf_dir):
    """The must-have-a-4-or-5 cut applied to the whole (unprepared) rating view."""
    return prep.keep_users_with_high_rating(_clean(spark, sf_dir))


def q_prepared_ratings(spark, sf_dir):
    return prep.prepare_ratings(ratings_view(spark, sf_dir), cut_input=True)


def q_prep_audit(spark, sf_dir):
    return prep.preparation_audit(ratings_view(spark, sf_dir))


def q_removed_keys(spark, sf_dir):
    return prep.removed_keys(ratings_view(spark, sf_dir))


def q_item_norms(spark, sf_dir):
    return item_norms(_prepared(spark, sf_dir))


def q_item_dot(spark, sf_dir):
    return pair_dots(_prepared(spark, sf_dir)).select("i", "j", "dot")


def _nano(c):
    """Nine decimal places, half up: outputs only; ranking and weights use the full value."""
    return F.floor(F.col(c) * F.lit(1e9) + F.lit(0.5)).cast("double") / F.lit(1e9)


def q_item_similarity(spark, sf_dir):
    return pair_similarities(_prepared(spark, sf_dir)).select("i", "j", _nano("sim").alias("sim"))


def q_item_neighbors(spark, sf_dir):
    return _recommender(spark, sf_dir).neighbors.select("movieId", "neighborId", _nano("sim").alias("sim"), "rnk")


def q_dense_cosine(spark, sf_dir):
    """5 x cosine of the user's dense profile row and the item's dense genre row, for every
    prepared rating of a content user.  Items without genres and users without a profile have
    a zero row, whose cosine is 0."""
    rec = _recommender(spark, sf_dir)
    c = rec.content
    prof = c.profile_vectors().select("userId", "pvec", squared_norm("pvec").alias("pn"))
    genres = F.coalesce("genres_arr", F.array().cast("array<string>"))
    items = rec.catalog.select("movieId").join(c.item_sigs.select("movieId", "genres_arr"), "movieId", "left").select(
        "movieId", genres.alias("genres_arr"), F.xxhash64(genres).alias("mark"))
    sets = materialize(items.select("mark", "genres_arr").distinct(), "genre_sets")
    hot = sets.select("mark", multi_hot("genres_arr", TEST_VIEW_GENRES).alias("gvec")).withColumn("gn", squared_norm("gvec"))
    n_sets, n_marks = sets.agg(F.count(F.lit(1)), F.count_distinct("mark")).first()
    pairs = rec.ratings.select("userId", "movieId")
    if n_sets == n_marks and fits_broadcast(n_sets, ITEM_ROW):
        # An item is two numbers, its id and its genre set's; the sets' rows are looked up beside the user's row, so
        # neither kind of row travels with a rating.
        marks = materialize(items.select("movieId", "mark"), "genre_marks")
        small = fits_broadcast(marks.count())
        pairs = pairs.join(maybe_broadcast(marks, small), "movieId").join(prof, "userId").join(F.broadcast(hot), "mark")
    else:
        rows = items.select("movieId", multi_hot("genres_arr", TEST_VIEW_GENRES).alias("gvec")).withColumn("gn", squared_norm("gvec"))
        pairs = pairs.join(prof, "userId").join(rows, "movieId")
    cosine = dense_cosine("pvec", "gvec", "pn", "gn")
    return pairs.select("userId", "movieId", from_micro(micro(F.lit(5.0) * cosine)).alias("cos5"))


def q_nested_lists(spark, sf_dir):
    """The nested per-user result (user -> ordered list of (title, score)), one row per place."""
    return flat_view(nested_view(_recommender(spark, sf_dir).top_n("content", N)))


def q_seen_pairs(spark, sf_dir):
    return seen_pairs(_prepared(spark, sf_dir))


def q_unseen_counts(spark, sf_dir):
    """Unseen rated catalog items per user, from the users' seen blocks over item positions."""
    r = _prepared(spark, sf_dir)
    items = rated_catalog_items(r, catalog_view(spark, sf_dir))
    total = items.select(F.count(F.lit(1))).scalar()
    index = dense_index(items, "movieId").withColumn("pos", F.col("pos") - 1)
    blocks = seen_blocks(seen_pairs(r).join(index, "movieId").select("userId", "pos"))
    return unseen_counts(r.select("userId").distinct(), blocks, total)


def q_item_based_scores(spark, sf_dir):
    rec = _recommender(spark, sf_dir)
    return item_based_scores(rec.ratings, rec.neighbors).select(
        "userId", "movieId", from_micro("score_micro").alias("score"))


def q_item_based_topn(spark, sf_dir):
    return _recommender(spark, sf_dir).top_n("item_based", N)


def q_recent_liked(spark, sf_dir):
    rec = _recommender(spark, sf_dir)
    return rec.content.recent.select("userId", "movieId", "rating", F.col("rnk").cast("int").alias("rnk"))


def q_user_genre_profile(spark, sf_dir):
    return _recommender(spark, sf_dir).content.profile


def q_content_topn(spark, sf_dir):
    return _recommender(spark, sf_dir).top_n("content", N)


def q_hybrid_topn(spark, sf_dir):
    return _recommender(spark, sf_dir).top_n("hybrid", N)


def q_random_topn(spark, sf_dir):
    return _recommender(spark, sf_dir).top_n("random", N)


def q_report_first_users(spark, sf_dir):
    return _recommender(spark, sf_dir).report("item_based", N, M)


def q_all_methods_report(spark, sf_dir):
    return _recommender(spark, sf_dir).full_report(N, M)


def q_all_methods_topn(spark, sf_dir):
    return run_all(ratings_view(spark, sf_dir), catalog_view(spark, sf_dir), N, K, TEST_VIEW_GENRES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings_view": q_ratings_view,
    "catalog_genres": q_catalog_genres,
    "activity_threshold": q_activity_threshold,
    "filter_low_activity_items": q_filter_low_activity_items,
    "filter_low_activity_users": q_filter_low_activity_users,
    "high_rating_filter": q_high_rating_filter,
    "prepared_ratings": q_prepared_ratings,
    "prep_audit": q_prep_audit,
    "removed_keys": q_removed_keys,
    "item_norms": q_item_norms,
    "item_dot": q_item_dot,
    "item_similarity": q_item_similarity,
    "item_neighbors": q_item_neighbors,
    "dense_cosine": q_dense_cosine,
    "nested_lists": q_nested_lists,
    "seen_pairs": q_seen_pairs,
    "unseen_counts": q_unseen_counts,
    "item_based_scores": q_item_based_scores,
    "item_based_topn": q_item_based_topn,
    "recent_liked": q_recent_liked,
    "user_genre_profile": q_user_genre_profile,
    "content_topn": q_content_topn,
    "hybrid_topn": q_hybrid_topn,
    "random_topn": q_random_topn,
    "report_first_users": q_report_first_users,
    "all_methods_topn": q_all_methods_topn,
    "all_methods_report": q_all_methods_report,
}
