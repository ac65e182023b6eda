"""MinHash near-duplicates against all pairs."""

import random

import numpy as np
import pytest

from cinerank.llm import near_dup as N
from tests.llm.conftest import prose
from tests.llm.test_text import words_of


def shingles(t, k):
    w = words_of(t or "", "space")
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({("short", *w)} if w else set())


def brute(rows, k, threshold=80):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        comp = (min(ids) if ids else None) if sets[i] else doc
        out.append((doc, len(sets[i]), comp, doc == comp))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(8)
    rows, doc = [], 500
    for _ in range(8):  # families of chains: each copy changes a word or two of some earlier one
        family = [prose(rng, rng.randint(30, 80)).split()]
        for _ in range(rng.randint(1, 25)):
            w = list(rng.choice(family))
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "changed%d" % rng.randint(0, 10**6)
            family.append(w)
        for w in family:
            doc -= 1
            rows.append((doc, " ".join(w)))
    rows += [(900 + i, prose(rng, rng.randint(1, 120))) for i in range(30)]
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "one two"),
             (1007, "one two"), (1007, "one two"), (None, "one two"), (None, "only null ids here"), (1008, "x " * 5000)]
    return rows


@pytest.mark.parametrize("k", [2, 5])
@pytest.mark.parametrize("block", [N.BLOCK, 3])
def test_equals_all_pairs(docs, cases, k, block):
    got = N.near_duplicates(docs(cases, extra=True), shingle=k, block=block).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got], key=repr) == brute(cases, k)


def test_remove_keeps_one_of_each_group(docs, cases):
    df = docs(cases, extra=True)
    kept = N.remove_near_duplicates(df)
    assert kept.columns == df.columns
    want = sorted({(r[0], r[2]) for r in brute(cases, 5) if r[3]}, key=repr)
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got, key=repr) == [i for i, _ in want]


def test_remove_keeps_one_of_near_copies_with_null_or_shared_ids(docs):
    rng = random.Random(21)
    a, b, c, d = (prose(rng, 200) for _ in range(4))
    near = lambda t: [t, t + " tail", "head " + t]
    rows = [(None, t) for t in near(a)] + [(None, a)] + [(5, t) for t in near(b)] + [(9, b + " other tail")] \
        + [(5, c), (5, c)] + [(None, near(d)[1]), (30, d)] + [(None, None), (None, "")]
    got = [(r.doc_id, r.text) for r in N.remove_near_duplicates(docs(rows)).collect()]
    one = {k: [i for i, t in got if t and t in group] for k, group in
           (("a", near(a)), ("b", near(b) + [b + " other tail"]), ("c", [c]), ("d", near(d)))}
    assert one == {"a": [None], "b": [5], "c": [5], "d": [30]}
    assert len(got) == 6 and {(None, None), (None, "")} <= set(got)


def test_components_small_and_shuffled(spark):
    rng = random.Random(1)
    links = [(a, a + rng.randint(1, 3)) for a in range(0, 200) if rng.random() < 0.6]
    df = spark.createDataFrame(links, "a long, b long")
    small = sorted(map(tuple, N.components(df).collect()))
    assert small == sorted(map(tuple, N.components(df, small_rows=0).collect()))
    root = dict(small)
    assert all(root[a] == root[b] for a, b in links)
    assert all(root[r] == r for r in root.values())


def test_sketch_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    k = N.BANDS * N.ROWS
    limit = N.sketch_limit(80, k)
    lost = 0
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
        a = np.sort(np.concatenate([both, rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
        b = np.sort(np.concatenate([both, rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
        x, y = N.min_hashes(a, k), N.min_hashes(b, k)
        assert abs((x == y).mean() - 0.8) < 0.2
        salt = N.mix(np.arange(1, k + 1, dtype=np.uint64))
        fold = lambda m: np.bincount((N.mix(m.astype(np.uint64) ^ salt) % np.uint64(512)).astype(int), minlength=512) & 1
        lost += int((fold(x) ^ fold(y)).sum()) > limit
    assert lost == 0


def test_empty_table(docs):
    assert N.near_duplicates(docs([])).collect() == []
    assert N.remove_near_duplicates(docs([])).collect() == []
