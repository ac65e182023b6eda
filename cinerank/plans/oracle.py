"""DuckDB SQL for each registered query, written the direct (brute-force) way:
sorted-index quartiles, full user x item candidate lists, explicit cosines.  Views
``lineitem orders part`` are expected to exist.  Same column names and quantisation as
the Spark plans, so results compare value for value.
"""

from __future__ import annotations

N = 5
M = 5
K = 100
SEED = 42
W_ITEM, W_CONTENT = "0.6", "0.4"

BASE = """
ratings AS (
  SELECT userId, movieId, CEIL(q / 5.0) / 2.0 AS rating, ts FROM (
    SELECT o.o_custkey AS userId, l.l_partkey AS movieId, l.l_quantity AS q,
           date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o.o_orderdate) AS ts,
           row_number() OVER (PARTITION BY o.o_custkey, l.l_partkey
                              ORDER BY o.o_orderdate DESC, l.l_orderkey DESC, l.l_linenumber DESC,
                                       l.l_quantity DESC) AS rn
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) t
  WHERE rn = 1),
catalog AS (
  SELECT p_partkey AS movieId, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS title,
         CASE WHEN p_size = 50 THEN '(no genres listed)'
              ELSE concat_ws('|', p_type, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) END AS genres
  FROM part)"""

PREP = """
r0 AS (SELECT * FROM ratings WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL
                               AND NOT isnan(rating) AND ts IS NOT NULL),
mc AS (SELECT movieId, count(*) AS cnt FROM r0 GROUP BY movieId),
mq AS (SELECT cnt AS q, n AS n_keys FROM (SELECT cnt, row_number() OVER (ORDER BY cnt) - 1 AS idx,
                                   count(*) OVER () AS n FROM mc) t WHERE idx = n // 4),
r1 AS (SELECT r0.* FROM r0 JOIN mc USING (movieId) WHERE mc.cnt > (SELECT q FROM mq)),
uc AS (SELECT userId, count(*) AS cnt FROM r1 GROUP BY userId),
uq AS (SELECT cnt AS q, n AS n_keys FROM (SELECT cnt, row_number() OVER (ORDER BY cnt) - 1 AS idx,
                                   count(*) OVER () AS n FROM uc) t WHERE idx = n // 4),
r2 AS (SELECT r1.* FROM r1 JOIN uc USING (userId) WHERE uc.cnt > (SELECT q FROM uq)),
prepared AS (SELECT * FROM r2 WHERE userId IN (SELECT userId FROM r2 WHERE trunc(rating) IN (4, 5))),
users AS (SELECT DISTINCT userId FROM prepared)"""

NEIGH = f"""
norms AS (SELECT movieId, sum(rating * rating) AS n2 FROM prepared GROUP BY movieId),
dots AS (SELECT a.movieId AS i, b.movieId AS j, sum(a.rating * b.rating) AS dot
         FROM prepared a JOIN prepared b ON a.userId = b.userId AND a.movieId <= b.movieId GROUP BY 1, 2),
sims AS (SELECT d.i, d.j, d.dot,
                CASE WHEN sqrt(x.n2) * sqrt(y.n2) = 0 THEN 0.0::DOUBLE
                     ELSE d.dot / (sqrt(x.n2) * sqrt(y.n2)) END AS sim
         FROM dots d JOIN norms x ON x.movieId = d.i JOIN norms y ON y.movieId = d.j),
both_dir AS (SELECT i AS movieId, j AS neighborId, sim FROM sims
             UNION ALL SELECT j, i, sim FROM sims WHERE i <> j),
rated_items AS (SELECT DISTINCT movieId FROM catalog WHERE movieId IN (SELECT movieId FROM prepared)),
neighbors AS (SELECT movieId, neighborId, sim, CAST(rnk AS INTEGER) AS rnk,
                CASE WHEN sim > 0 THEN greatest(1, CAST(floor(sim * 1e12 + 0.5) AS BIGINT)) ELSE 0 END AS w FROM (
                SELECT *, row_number() OVER (PARTITION BY movieId ORDER BY sim DESC, neighborId) AS rnk
                FROM both_dir) t
              WHERE rnk <= {K} AND movieId IN (SELECT movieId FROM rated_items))"""

ITEM = f"""
sup AS (SELECT p.userId, n.movieId, sum(n.w * p.rating) AS num, sum(n.w) AS den
        FROM neighbors n JOIN prepared p ON p.movieId = n.neighborId GROUP BY 1, 2),
cand AS (SELECT u.userId, r.movieId FROM users u CROSS JOIN rated_items r
         WHERE NOT EXISTS (SELECT 1 FROM prepared p WHERE p.userId = u.userId AND p.movieId = r.movieId)),
item_scored AS (SELECT c.userId, c.movieId,
                       CASE WHEN s.den > 0 THEN CAST(floor(s.num / CAST(s.den AS DOUBLE) * 1e6 + 0.5) AS BIGINT)
                            ELSE 0 END AS s
                FROM cand c LEFT JOIN sup s USING (userId, movieId)),
item_top AS (SELECT userId, movieId, s, CAST(row_number() OVER (PARTITION BY userId ORDER BY s DESC, movieId)
                                             AS INTEGER) AS rnk
             FROM item_scored QUALIFY rnk <= {N})"""

CONTENT = f"""
genre_less AS (SELECT movieId FROM catalog WHERE genres = '(no genres listed)'),
liked AS (SELECT userId, movieId, rating, ts FROM prepared
          WHERE trunc(rating) >= 3 AND movieId NOT IN (SELECT movieId FROM genre_less)),
recent AS (SELECT userId, movieId, rating, ts,
                  CAST(row_number() OVER (PARTITION BY userId ORDER BY ts DESC, movieId) AS INTEGER) AS rnk
           FROM liked QUALIFY rnk <= 5),
genre_items AS (SELECT DISTINCT movieId FROM catalog WHERE genres <> '(no genres listed)'),
item_genres AS (SELECT DISTINCT movieId, genre FROM (
                  SELECT movieId, unnest(string_split(genres, '|')) AS genre
                  FROM catalog WHERE genres <> '(no genres listed)') t),
g2 AS (SELECT movieId, count(*) AS g2 FROM item_genres GROUP BY movieId),
profile AS (SELECT r.userId, g.genre, sum(r.rating) AS weight
            FROM recent r JOIN item_genres g ON g.movieId = r.movieId GROUP BY 1, 2),
p2 AS (SELECT userId, sum(weight * weight) AS p2 FROM profile GROUP BY userId),
cusers AS (SELECT DISTINCT userId FROM recent),
cdots AS (SELECT p.userId, g.movieId, sum(p.weight) AS dot
          FROM profile p JOIN item_genres g ON g.genre = p.genre GROUP BY 1, 2),
content_score AS (SELECT d.userId, d.movieId,
                         CAST(floor(5.0 * d.dot / (sqrt(p2.p2) * sqrt(CAST(g2.g2 AS DOUBLE))) * 1e6 + 0.5)
                              AS BIGINT) AS c
                  FROM cdots d JOIN p2 USING (userId) JOIN g2 USING (movieId)),
ccand AS (SELECT u.userId, g.movieId FROM cusers u CROSS JOIN genre_items g
          WHERE NOT EXISTS (SELECT 1 FROM prepared p WHERE p.userId = u.userId AND p.movieId = g.movieId)),
content_top AS (SELECT c.userId, c.movieId, coalesce(s.c, 0) AS c,
                       CAST(row_number() OVER (PARTITION BY c.userId ORDER BY coalesce(s.c, 0) DESC, c.movieId)
                            AS INTEGER) AS rnk
                FROM ccand c LEFT JOIN content_score s USING (userId, movieId) QUALIFY rnk <= {N})"""

HYBRID = f"""
hcand AS (SELECT i.userId, i.movieId, {W_ITEM} * i.s + {W_CONTENT} * coalesce(cs.c, 0) AS h
          FROM item_scored i JOIN cusers USING (userId) LEFT JOIN content_score cs USING (userId, movieId)),
hybrid_top AS (SELECT userId, movieId, h,
                      CAST(row_number() OVER (PARTITION BY userId ORDER BY h DESC, movieId) AS INTEGER) AS rnk
               FROM hcand QUALIFY rnk <= {N})"""


def _h32(text: str) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def _floyd() -> str:
    """CTEs f0 .. f(N-1): one distinct rank per step among n_unseen ranks."""
    out = []
    for t in range(N):
        prior = [f"p{i}" for i in range(t)]
        last = f"(n_unseen - k + {t})"
        draw = f"({_h32(f"concat_ws(':', {SEED}, 'pick', userId, {t})")} % ({last} + 1))"
        taken = " OR ".join(f"{draw} = {p}" for p in prior) or "FALSE"
        out.append(f"f{t} AS (SELECT *, CASE WHEN k <= {t} THEN NULL WHEN {taken} THEN {last} ELSE {draw} END AS p{t}"
                   f" FROM {f'f{t - 1}' if t else 'unseen'})")
    return ",\n".join(out)


RANDOM = f"""
cat_items AS (SELECT DISTINCT movieId FROM catalog),
free_items AS (SELECT u.userId, c.movieId, row_number() OVER (PARTITION BY u.userId ORDER BY c.movieId) - 1 AS r
               FROM users u CROSS JOIN cat_items c
               WHERE NOT EXISTS (SELECT 1 FROM prepared s WHERE s.userId = u.userId AND s.movieId = c.movieId)),
unseen AS (SELECT userId, count(*) AS n_unseen, least({N}, count(*)) AS k FROM free_items GROUP BY userId),
{_floyd()},
ranks AS (SELECT userId, unnest([{', '.join(f'p{t}' for t in range(N))}]) AS r FROM f{N - 1}),
chosen AS (SELECT f.userId, f.movieId FROM free_items f JOIN ranks x ON x.userId = f.userId AND x.r = f.r),
random_scored AS (SELECT userId, movieId,
                         1.0 + 4.0 * (CAST({_h32(f"concat_ws(':', {SEED}, 'score', userId, movieId)")} AS DOUBLE)
                                      / 4294967296.0) AS score
                  FROM chosen),
random_top AS (SELECT userId, movieId, score,
                      CAST(row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS INTEGER) AS rnk
               FROM random_scored)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _titled(top: str, score: str) -> str:
    return (f"SELECT t.userId, t.rnk, t.movieId, c.title, {score} AS score "
            f"FROM {top} t LEFT JOIN catalog c USING (movieId)")


ITEM_OUT = _titled("item_top", "CAST(t.s AS DOUBLE) / 1e6")
CONTENT_OUT = _titled("content_top", "CAST(t.c AS DOUBLE) / 1e6")
HYBRID_OUT = _titled("hybrid_top", "CAST(t.h AS DOUBLE) / 1e6")
RANDOM_OUT = _titled("random_top", "t.score")

def _report_cte(tag: str, top: str, users: str, score: str) -> str:
    """CTEs ``{tag}_first``, ``{tag}_lines`` for one method's report section."""
    return f"""
{tag}_first AS (SELECT userId, CAST(row_number() OVER (ORDER BY userId) AS INTEGER) AS line_no
            FROM {users} QUALIFY line_no <= {M}),
{tag}_txt AS (SELECT t.userId, t.rnk,
                     chr(9) || CAST(t.rnk AS VARCHAR) || ')''' || c.title || ''' score: '
                     || CAST({score} AS VARCHAR) || '/5' AS txt
              FROM {top} t LEFT JOIN catalog c USING (movieId)),
{tag}_lines AS (SELECT f.line_no, 'User: ' || CAST(f.userId AS VARCHAR) || ' -> '
                 || coalesce(string_agg(i.txt, ';' ORDER BY i.rnk), '') AS value
          FROM {tag}_first f LEFT JOIN {tag}_txt i USING (userId) GROUP BY f.line_no, f.userId)"""


def _report_section(tag: str, title: str, offset: int) -> str:
    return (f"SELECT {offset} AS line_no, '{title}' AS value "
            f"UNION ALL SELECT line_no + {offset}, value FROM {tag}_lines "
            f"UNION ALL SELECT CAST((SELECT count(*) FROM {tag}_first) + 1 + {offset} AS INTEGER), ''")


REPORT = _report_cte("item", "item_top", "users", "CAST(t.s AS DOUBLE) / 1e6")
REPORTS_ALL = ",".join([
    _report_cte("rnd", "random_top", "users", "t.score"),
    REPORT,
    _report_cte("cnt", "content_top", "cusers", "CAST(t.c AS DOUBLE) / 1e6"),
    _report_cte("hyb", "hybrid_top", "cusers", "CAST(t.h AS DOUBLE) / 1e6"),
])


def oracle_sql() -> dict[str, str]:
    b, p = BASE, PREP
    q = {
        "ratings_view": _with(b) + " SELECT userId, movieId, rating, ts FROM ratings",
        "catalog_genres": _with(b) + """ SELECT DISTINCT movieId, genre FROM (
              SELECT movieId, unnest(string_split(genres, '|')) AS genre
              FROM catalog WHERE genres <> '(no genres listed)') t""",
        "activity_threshold": _with(b, p) + """ SELECT 'movieId' AS key_kind, n_keys, q AS threshold FROM mq
              UNION ALL SELECT 'userId', n_keys, q FROM uq""",
        "filter_low_activity_items": _with(b, p) + " SELECT userId, movieId, rating, ts FROM r1",
        "filter_low_activity_users": _with(b, p) + " SELECT userId, movieId, rating, ts FROM r2",
        "high_rating_filter": _with(b, p) + """ SELECT userId, movieId, rating, ts FROM r0
              WHERE userId IN (SELECT userId FROM r0 WHERE trunc(rating) IN (4, 5))""",
        "prepared_ratings": _with(b, p) + " SELECT userId, movieId, rating, ts FROM prepared",
        "prep_audit": _with(b, p) + """ SELECT 'movieId' AS step, (SELECT q FROM mq) AS threshold,
                 (SELECT count(*) FROM r0) AS rows_before, (SELECT count(*) FROM r1) AS rows_after,
                 (SELECT count(DISTINCT movieId) FROM r0) - (SELECT count(DISTINCT movieId) FROM r1) AS n_removed
              UNION ALL SELECT 'userId', (SELECT q FROM uq), (SELECT count(*) FROM r1), (SELECT count(*) FROM r2),
                 (SELECT count(DISTINCT userId) FROM r1) - (SELECT count(DISTINCT userId) FROM r2)
              UNION ALL SELECT 'high_rating', NULL, (SELECT count(*) FROM r2), (SELECT count(*) FROM prepared),
                 (SELECT count(DISTINCT userId) FROM r2) - (SELECT count(DISTINCT userId) FROM prepared)""",
        "removed_keys": _with(b, p) + """ SELECT 'movieId' AS step, movieId AS removed_key FROM
                 (SELECT DISTINCT movieId FROM r0 EXCEPT SELECT DISTINCT movieId FROM r1) a
              UNION ALL SELECT 'userId', userId FROM (SELECT DISTINCT userId FROM r1 EXCEPT SELECT DISTINCT userId FROM r2) b
              UNION ALL SELECT 'high_rating', userId FROM
                 (SELECT DISTINCT userId FROM r2 EXCEPT SELECT DISTINCT userId FROM prepared) c""",
        "item_norms": _with(b, p) + " SELECT movieId, sqrt(sum(rating * rating)) AS norm FROM prepared GROUP BY movieId",
        "item_dot": _with(b, p, NEIGH) + " SELECT i, j, dot FROM dots",
        "item_similarity": _with(b, p, NEIGH) + " SELECT i, j, floor(sim * 1e9 + 0.5) / 1e9 AS sim FROM sims",
        "item_neighbors": _with(b, p, NEIGH) + """ SELECT movieId, neighborId, floor(sim * 1e9 + 0.5) / 1e9 AS sim, rnk
              FROM neighbors""",
        "dense_cosine": _with(b, p, CONTENT) + """,
              rated_dots AS (SELECT r.userId, r.movieId, sum(f.weight) AS dot FROM prepared r
                 JOIN item_genres g ON g.movieId = r.movieId
                 JOIN profile f ON f.userId = r.userId AND f.genre = g.genre GROUP BY 1, 2)
              SELECT r.userId, r.movieId, CAST(floor(coalesce(5.0 * (d.dot / (sqrt(p2.p2) * sqrt(CAST(g2.g2 AS DOUBLE)))), 0)
                 * 1e6 + 0.5) AS DOUBLE) / 1e6 AS cos5
              FROM prepared r JOIN cusers USING (userId) JOIN (SELECT DISTINCT movieId FROM catalog) c USING (movieId)
              LEFT JOIN p2 USING (userId) LEFT JOIN g2 USING (movieId) LEFT JOIN rated_dots d USING (userId, movieId)""",
        "nested_lists": _with(b, p, CONTENT) + f""" SELECT userId, rnk AS pos, title, score FROM ({CONTENT_OUT}) t""",
        "seen_pairs": _with(b, p) + " SELECT DISTINCT userId, movieId FROM prepared",
        "unseen_counts": _with(b, p, NEIGH) + """ SELECT u.userId, (SELECT count(*) FROM rated_items)
                 - (SELECT count(*) FROM prepared s WHERE s.userId = u.userId
                    AND s.movieId IN (SELECT movieId FROM rated_items)) AS n_unseen FROM users u""",
        "item_based_scores": _with(b, p, NEIGH, ITEM) + """ SELECT s.userId, s.movieId, CAST(floor(s.num / CAST(s.den AS DOUBLE)
                 * 1e6 + 0.5) AS DOUBLE) / 1e6 AS score
              FROM sup s WHERE s.den > 0 AND NOT EXISTS (SELECT 1 FROM prepared p
                 WHERE p.userId = s.userId AND p.movieId = s.movieId)""",
        "item_based_topn": _with(b, p, NEIGH, ITEM) + " " + ITEM_OUT,
        "recent_liked": _with(b, p, CONTENT) + " SELECT userId, movieId, rating, rnk FROM recent",
        "user_genre_profile": _with(b, p, CONTENT) + " SELECT userId, genre, weight FROM profile",
        "content_topn": _with(b, p, CONTENT) + " " + CONTENT_OUT,
        "hybrid_topn": _with(b, p, NEIGH, ITEM, CONTENT, HYBRID) + " " + HYBRID_OUT,
        "random_topn": _with(b, p, RANDOM) + " " + RANDOM_OUT,
        "report_first_users": _with(b, p, NEIGH, ITEM, REPORT) + " "
        + _report_section("item", "Item-based Collaborative Filtering Recommender", 0),
        "all_methods_report": _with(b, p, NEIGH, ITEM, CONTENT, HYBRID, RANDOM, REPORTS_ALL)
        + " SELECT 0 AS line_no, 'DIFFERENT RECOMMENDER SYSTEMS RESULTS' AS value UNION ALL SELECT 1, '---'"
        + " UNION ALL SELECT 2, '' UNION ALL "
        + " UNION ALL ".join(_report_section(tag, title, 3 + s * (M + 2)) for s, (tag, title) in enumerate([
            ("rnd", "Random Recommender"),
            ("item", "New Item-based Collaborative Filtering Recommender"),
            ("item", "Item-based Collaborative Filtering Recommender"),
            ("cnt", "Content Based Recommender"),
            ("hyb", "Hybrid Filtering Recommender")])),
        "all_methods_topn": _with(b, p, NEIGH, ITEM, CONTENT, HYBRID, RANDOM) + f"""
              SELECT 'random' AS method, * FROM ({RANDOM_OUT}) r
              UNION ALL SELECT 'item_based', * FROM ({ITEM_OUT}) i
              UNION ALL SELECT 'content', * FROM ({CONTENT_OUT}) c
              UNION ALL SELECT 'hybrid', * FROM ({HYBRID_OUT}) h""",
    }
    return q
