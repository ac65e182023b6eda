"""Plain-Python statement of every method (dicts and loops), written from the method
descriptions, used to check the Spark plans on small fixtures.  Same tie rules and the
same quantisation: floor(x * 1e6 + 0.5) after exact sums and one division."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

NO_GENRES = "(no genres listed)"


def micro(x: float) -> int:
    return math.floor(x * 1e6 + 0.5)


def trunc(x: float) -> int:
    return int(x)


def prepare(rows):
    rows = [r for r in rows if all(v is not None for v in r) and not math.isnan(r[2])]

    def cut(rows, idx):
        counts = Counter(r[idx] for r in rows)
        if not counts:
            return []
        ordered = sorted(counts.values())
        q = ordered[len(ordered) // 4]
        return [r for r in rows if counts[r[idx]] > q]

    rows = cut(rows, 1)
    rows = cut(rows, 0)
    high = {r[0] for r in rows if trunc(r[2]) in (4, 5)}
    return [r for r in rows if r[0] in high]


def ratings_by_user(rows):
    d = defaultdict(dict)
    for u, m, r, _ in rows:
        d[u][m] = r
    return d


def neighbors(rows, catalog, k):
    by_item = defaultdict(dict)
    for u, m, r, _ in rows:
        by_item[m][u] = r
    n2 = {i: sum(v * v for v in d.values()) for i, d in by_item.items()}
    rated_catalog = sorted(set(by_item) & {c[0] for c in catalog})
    out = {}
    for i in rated_catalog:
        cand = []
        for j in by_item:
            common = set(by_item[i]) & set(by_item[j])
            if not common:
                continue
            dot = sum(by_item[i][u] * by_item[j][u] for u in common)
            den = math.sqrt(n2[i]) * math.sqrt(n2[j])
            cand.append((0.0 if den == 0 else dot / den, j))
        cand.sort(key=lambda t: (-t[0], t[1]))
        out[i] = [(max(1, math.floor(s * 1e12 + 0.5)) if s > 0 else 0, j) for s, j in cand[:k]]
    return out


def item_scores(rows, catalog, k):
    nb = neighbors(rows, catalog, k)
    seen = ratings_by_user(rows)
    scores = {}
    for u, rated in seen.items():
        for i, lst in nb.items():
            if i in rated:
                continue
            num = sum(s * rated[j] for s, j in lst if j in rated)
            den = sum(s for s, j in lst if j in rated)
            scores[(u, i)] = micro(num / den) if den > 0 else 0
    return scores


def top(per_user_scores, n):
    out = {}
    for u, items in per_user_scores.items():
        ranked = sorted(items.items(), key=lambda t: (-t[1], t[0]))[:n]
        out[u] = ranked
    return out


def item_based(rows, catalog, n=5, k=100):
    sc = item_scores(rows, catalog, k)
    per = defaultdict(dict)
    for u in ratings_by_user(rows):
        per[u] = {}
    for (u, i), s in sc.items():
        per[u][i] = s
    return {u: [(i, s / 1e6) for i, s in lst] for u, lst in top(per, n).items()}


def genre_sets(catalog, vocabulary):
    out = {}
    for m, _, g in catalog:
        if g == NO_GENRES:
            continue
        parts = g.split("|")
        for p in parts:
            if p not in vocabulary:
                raise ValueError(p)
        out[m] = sorted(set(parts))
    return out


def content_parts(rows, catalog, vocabulary):
    genre_less = {m for m, _, g in catalog if g == NO_GENRES}
    gs = genre_sets(catalog, vocabulary)
    liked = defaultdict(list)
    for u, m, r, ts in rows:
        if trunc(r) >= 3 and m not in genre_less:
            liked[u].append((ts, m, r))
    profile = {}
    for u, lst in liked.items():
        lst.sort(key=lambda t: (-t[0], t[1]))
        w = defaultdict(float)
        for _, m, r in lst[:5]:
            for g in gs.get(m, []):
                w[g] += r
        profile[u] = dict(w)
    return profile, gs


def content_score(prof, genres):
    dot = sum(prof.get(g, 0.0) for g in genres)
    p2 = sum(v * v for v in prof.values())
    den = math.sqrt(p2) * math.sqrt(float(len(genres)))
    return 0 if den == 0 else micro((5.0 * dot) / den)


def content_based(rows, catalog, vocabulary, n=5):
    profile, gs = content_parts(rows, catalog, vocabulary)
    seen = ratings_by_user(rows)
    per = {}
    for u, prof in profile.items():
        per[u] = {i: content_score(prof, g) for i, g in gs.items() if i not in seen.get(u, {})}
    return {u: [(i, s / 1e6) for i, s in lst] for u, lst in top(per, n).items()}


def hybrid(rows, catalog, vocabulary, n=5, k=100, wi=6, wc=4, scale=10):
    sc = item_scores(rows, catalog, k)
    profile, gs = content_parts(rows, catalog, vocabulary)
    per = {}
    for u, prof in profile.items():
        per[u] = {}
    for (u, i), s in sc.items():
        if u in per:
            c = content_score(profile[u], gs[i]) if i in gs else 0
            per[u][i] = wi * s + wc * c
    return {u: [(i, h / scale / 1e6) for i, h in lst] for u, lst in top(per, n).items()}


def _h32(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def random_rec(rows, catalog, n=5, seed=42):
    """Floyd's sample of ranks among the user's unseen items, in id order."""
    ids = sorted({c[0] for c in catalog})
    out = {}
    for u, rated in ratings_by_user(rows).items():
        free = [m for m in ids if m not in rated]
        k = min(n, len(free))
        ranks = []
        for t in range(k):
            last = len(free) - k + t
            draw = _h32(f"{seed}:pick:{u}:{t}") % (last + 1)
            ranks.append(last if draw in ranks else draw)
        scored = [(free[r], 1.0 + 4.0 * (_h32(f"{seed}:score:{u}:{free[r]}") / 4294967296.0)) for r in ranks]
        out[u] = sorted(scored, key=lambda t: (-t[1], t[0]))
    return out
