"""cinerank: top-N movie recommendation on Spark DataFrames.

Ratings ``(userId, movieId, rating, ts)`` and a catalog ``(movieId, title, genres)`` go in;
ranked ``(userId, rnk, movieId, title, score)`` rows come out.  Every method is a plan of
joins, aggregates and windows; the driver only receives scalar counts for
broadcast size checks, never data.
"""

from cinerank.operators.prep import prepare_ratings, remove_low_activity, keep_users_with_high_rating
from cinerank.operators.neighbors import item_neighbors
from cinerank.operators.item_based import item_based_recommendations
from cinerank.operators.content import content_based_recommendations
from cinerank.operators.hybrid import hybrid_recommendations
from cinerank.operators.random_rec import random_recommendations
from cinerank.operators.report import report_lines
from cinerank.plans.pipeline import run_all

__all__ = [
    "prepare_ratings",
    "remove_low_activity",
    "keep_users_with_high_rating",
    "item_neighbors",
    "item_based_recommendations",
    "content_based_recommendations",
    "hybrid_recommendations",
    "random_recommendations",
    "report_lines",
    "run_all",
]
