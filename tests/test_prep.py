"""Preparation step: hand-computed fixtures."""

import math

from cinerank.operators import prep
from tests import oracle_py


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_quartile_cut_keeps_counts_above_index_n_over_4(frames):
    # keys 1..4 rated 1, 2, 3, 4 times: threshold = sorted counts[4 // 4] = 2
    data = [(u, m, 4.0, u) for m in (1, 2, 3, 4) for u in range(m)]
    r, _ = frames(data)
    kept = prep.remove_low_activity(r, "movieId")
    assert sorted({row.movieId for row in kept.collect()}) == [3, 4]
    thr = prep.quartile_threshold(prep.key_counts(r, "movieId")).collect()
    assert [(t.n_keys, t.threshold) for t in thr] == [(4, 2)]


def test_uniform_counts_empty_the_table(frames):
    r, _ = frames([(u, m, 4.0, 0) for m in (1, 2, 3) for u in range(3)])
    assert prep.remove_low_activity(r, "movieId").count() == 0


def test_empty_input_gives_empty_result(frames):
    r, _ = frames([])
    assert prep.prepare_ratings(r).count() == 0
    assert prep.quartile_threshold(prep.key_counts(r, "movieId")).count() == 0


def test_user_cut_counts_on_the_item_cut_table(frames):
    data = [(u, m, 4.0, 0) for m in range(1, 9) for u in range(m)] + [(50, 1, 5.0, 0), (50, 2, 5.0, 0)]
    r, _ = frames(data)
    assert rows_of(prep.prepare_ratings(r)) == sorted(oracle_py.prepare(data))


def test_truncation_and_high_rating_filter(frames):
    data = [(1, 1, 2.5, 0), (1, 2, 3.0, 0), (2, 1, 3.5, 0), (3, 2, 4.5, 0), (4, 3, 5.0, 0)]
    r, _ = frames(data)
    kept = {row.userId for row in prep.keep_users_with_high_rating(r).collect()}
    assert kept == {3, 4}  # 3.5 truncates to 3, 4.5 to 4


def test_nulls_and_nan_are_dropped(frames):
    data = [(1, 1, None, 0), (1, 2, float("nan"), 0), (None, 3, 4.0, 0), (2, 4, 4.0, 0)]
    r, _ = frames(data)
    assert rows_of(prep.drop_incomplete(r)) == [(2, 4, 4.0, 0)]


def test_prepare_matches_python_statement_on_random_data(frames):
    import random
    rng = random.Random(7)
    data = [(rng.randrange(40), rng.randrange(60), rng.randrange(1, 11) / 2, rng.randrange(100)) for _ in range(900)]
    data = list({(u, m): (u, m, r, t) for u, m, r, t in data}.values())
    r, _ = frames(data)
    assert rows_of(prep.prepare_ratings(r)) == sorted(oracle_py.prepare(data))


def test_audit_and_removed_keys(frames):
    data = [(u, m, 4.0 if u % 2 else 2.0, 0) for m in range(1, 9) for u in range(m + 2)]
    r, _ = frames(data)
    audit = {a.step: a for a in prep.preparation_audit(r).collect()}
    assert audit["movieId"].rows_before == len(data)
    assert audit["movieId"].rows_after == audit["userId"].rows_before
    removed = prep.removed_keys(r).collect()
    assert {(x.step, x.removed_key) for x in removed if x.step == "movieId"} == \
        {("movieId", m) for m in range(1, 9) if not m > sorted(range(3, 11))[8 // 4] - 2}
    assert not math.isnan(audit["userId"].threshold)


def test_dedup_keeps_latest(frames):
    r, _ = frames([(1, 1, 2.0, 5), (1, 1, 4.0, 9), (1, 2, 3.0, 1), (2, 1, 1.0, 3), (2, 1, 5.0, 3)])
    assert rows_of(prep.dedup_ratings(r)) == [(1, 1, 4.0, 9), (1, 2, 3.0, 1), (2, 1, 5.0, 3)]
