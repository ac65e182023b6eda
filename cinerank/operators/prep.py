"""Rating-table preparation.

1. drop rows with a null or NaN field;
2. drop items whose rating count is not above the lower quartile of item counts;
3. the same for users, counted on the table left by step 2;
4. drop users without a rating whose integer part is 4 or 5.

Quartile rule: sort the per-key counts ascending and take the element at 0-based index
``n // 4`` (n = number of keys) as threshold q; keys with count > q stay.  A key with
count c stays exactly when more than ``n // 4`` keys have a count below c, so the cut is
found from the histogram count -> number of keys.  The histogram has at most one row per
distinct count value (<= sqrt(2 * rows)), which is the only data the cumulative sum
sees in one partition; every table-sized step is a partitioned aggregate or join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinerank.functions.columns import truncated
from cinerank.operators.joins import fits_broadcast, maybe_broadcast

HIGH_RATINGS = (4, 5)


def drop_incomplete(ratings: DataFrame) -> DataFrame:
    return ratings.na.drop()


def dedup_ratings(ratings: DataFrame) -> DataFrame:
    """One row per (userId, movieId): the latest ``ts`` wins, then the higher rating.

    The methods assume unique (user, item) pairs; this makes them so.  A hash aggregate
    over a struct maximum, so duplicates are merged map-side before the shuffle.
    """
    latest = F.max(F.struct(F.col("ts"), F.col("rating"))).alias("latest")
    return (ratings.groupBy("userId", "movieId").agg(latest)
            .select("userId", "movieId", F.col("latest.rating").alias("rating"), F.col("latest.ts").alias("ts")))


def key_counts(ratings: DataFrame, key: str) -> DataFrame:
    return ratings.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def count_histogram(counts: DataFrame) -> DataFrame:
    """``cnt, n_at, n_below, n_keys`` from per-key counts (one row per distinct count)."""
    hist = counts.groupBy("cnt").agg(F.count(F.lit(1)).alias("n_at"))
    whole = Window.partitionBy()
    before = Window.partitionBy().orderBy("cnt").rowsBetween(Window.unboundedPreceding, -1)
    return (hist
            .withColumn("n_below", F.coalesce(F.sum("n_at").over(before), F.lit(0)))
            .withColumn("n_keys", F.sum("n_at").over(whole)))


def quartile_threshold(counts: DataFrame) -> DataFrame:
    """One row ``n_keys, threshold``; no row for an empty input."""
    hist = count_histogram(counts)
    at_index = hist.where((F.col("n_below") <= F.floor(F.col("n_keys") / 4))
                          & (F.col("n_below") + F.col("n_at") > F.floor(F.col("n_keys") / 4)))
    return at_index.select("n_keys", F.col("cnt").alias("threshold"))


def threshold(counts: DataFrame) -> Column:
    """The quartile threshold as a scalar subquery (null for an empty input)."""
    return quartile_threshold(counts).select(F.max("threshold")).scalar()


def remove_low_activity(ratings: DataFrame, key: str) -> DataFrame:
    """Keep the rows of keys rated more often than the lower-quartile count."""
    counts = key_counts(ratings, key)
    keep = counts.where(F.col("cnt") > threshold(counts)).select(key)
    return ratings.join(keep, key, "left_semi")


def users_with_high_rating(ratings: DataFrame) -> DataFrame:
    return (ratings.where(truncated("rating").isin(*HIGH_RATINGS))
            .select("userId").distinct())


def keep_users_with_high_rating(ratings: DataFrame) -> DataFrame:
    return ratings.join(users_with_high_rating(ratings), "userId", "left_semi")


def preparation_steps(ratings: DataFrame, cut: bool = False) -> list[tuple[str, DataFrame, DataFrame]]:
    """``(step, before, after)`` for the three cuts, in order.

    With ``cut`` every intermediate table is written under the checkpoint folder, so the
    audit's several counts per table read files instead of replaying the chain.
    """
    def keep(df: DataFrame, name: str) -> DataFrame:
        if not cut:
            return df
        from cinerank.session import materialize
        return materialize(df, name)

    clean = keep(drop_incomplete(ratings), "audit_clean")
    by_item = keep(remove_low_activity(clean, "movieId"), "audit_items")
    by_user = keep(remove_low_activity(by_item, "userId"), "audit_users")
    high = keep(keep_users_with_high_rating(by_user), "audit_high")
    return [("movieId", clean, by_item), ("userId", by_item, by_user), ("high_rating", by_user, high)]


def prepare_ratings(ratings: DataFrame, cut_input: bool = False) -> DataFrame:
    """The three cuts: one aggregation per item, one per user of the item-cut table and one filter.

    The user aggregation gives both the activity count and the has-a-4-or-5 flag (the user cut
    removes whole users, so the flag is the same before and after it).  With ``cut_input`` the
    cleaned input is written once under the checkpoint folder, and so are the counts per item and
    per user (one small row a key): thresholds and cuts read those instead of counting again.  The input
    and the counts per user are bucketed by user, so the user cut needs no exchange; nor does the item cut
    while the items' ids pass the size check (beyond it the cut table is written once, by user again).
    """
    def keep(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        if not cut_input:
            return df
        from cinerank.session import materialize, materialize_by
        return materialize(df, name) if by is None else materialize_by(df, name, by)

    clean = keep(drop_incomplete(ratings), "ratings", "userId")
    items = keep(key_counts(clean, "movieId"), "item_counts")
    small = cut_input and fits_broadcast(items.count())
    kept = items.where(F.col("cnt") > threshold(items)).select("movieId")
    by_item = clean.join(maybe_broadcast(kept, small), "movieId", "left_semi")
    if not small:
        by_item = keep(by_item, "item_cut", "userId")
    high = F.max(F.when(truncated("rating").isin(*HIGH_RATINGS), 1).otherwise(0))
    users = keep(by_item.groupBy("userId").agg(F.count(F.lit(1)).alias("cnt"), high.alias("high")), "user_counts", "userId")
    active = users.where((F.col("cnt") > threshold(users.select("userId", "cnt"))) & (F.col("high") == 1))
    return by_item.join(active.select("userId"), "userId", "left_semi")


def _step_key(step: str) -> str:
    return "movieId" if step == "movieId" else "userId"


def preparation_audit(ratings: DataFrame, cut: bool = True) -> DataFrame:
    """``step, threshold, rows_before, rows_after, n_removed`` (threshold NULL for the
    high-rating step; n_removed counts distinct removed keys)."""
    parts = []
    for step, before, after in preparation_steps(ratings, cut):
        key = _step_key(step)
        if step == "high_rating":
            thr = F.lit(None).cast("long")
        else:
            thr = threshold(key_counts(before, key))
        rows_before = before.select(F.count(F.lit(1))).scalar()
        rows_after = after.select(F.count(F.lit(1))).scalar()
        removed = removed_keys_of(before, after, key).select(F.count(F.lit(1))).scalar()
        parts.append(before.sparkSession.range(1).select(
            F.lit(step).alias("step"), thr.alias("threshold"), rows_before.alias("rows_before"),
            rows_after.alias("rows_after"), removed.alias("n_removed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def removed_keys_of(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Distinct keys present before and absent after (each cut removes whole keys)."""
    return before.select(key).distinct().join(after.select(key).distinct(), key, "left_anti")


def removed_keys(ratings: DataFrame, cut: bool = True) -> DataFrame:
    """``step, removed_key`` for every key removed by each cut."""
    out = None
    for step, before, after in preparation_steps(ratings, cut):
        key = _step_key(step)
        part = removed_keys_of(before, after, key).select(
            F.lit(step).alias("step"), F.col(key).alias("removed_key"))
        out = part if out is None else out.unionByName(part)
    return out
