"""Deleted interpolation against a dictionary model."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cinerank.llm import lm
from tests.llm.conftest import prose
from tests.llm.test_text import words_of


def role(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randint(0, 120))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "The THE the"), (502, "The THE the"), (None, "a null id"),
                   (503, "of the and " * 4000)]


@pytest.mark.parametrize("fan", [256, 4])
def test_base_score_and_counts(docs, cases, monkeypatch, fan):
    monkeypatch.setattr(lm, "FAN", fan)  # one level, several levels
    tokens = [(i, words_of(t or "", "space") + [None]) for i, t in cases]
    c = Counter(w for i, ws in tokens if role(i) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    got = lm.score_documents(docs(cases, extra=True).repartition(9)).collect()  # many chunks
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr)
    want = sorted(((i, role(i) == 2, len(ws), sum(c[w] > 0 for w in ws), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens), key=repr)
    assert have == want
    assert all(r.score < 0 for r in got)


def test_rows_grow_with_the_chunks(spark, docs, monkeypatch):
    """However many chunks there are, each has at most FAN rows on a level, and levels give the same counts."""
    rng = random.Random(31)
    df = docs([(i, prose(rng, 60)) for i in range(240)]).repartition(24)  # three chunks a task
    whole = {r.doc_id: (r.n_known, r.base_score, r.score) for r in lm.score_documents(df).collect()}
    monkeypatch.setattr(lm, "FAN", 5)
    written: dict[str, list] = {}
    real = lm.materialize
    monkeypatch.setattr(lm, "materialize", lambda df, name: (written.setdefault(name, []).append(real(df, name)), written[name][-1])[1])
    levels = {r.doc_id: (r.n_known, r.base_score, r.score) for r in lm.score_documents(df).collect()}
    assert levels.keys() == whole.keys()
    assert all(levels[i][0] == whole[i][0] and levels[i][1:] == pytest.approx(whole[i][1:], rel=1e-12) for i in whole)
    n = written["lm-chunks"][0].count()
    assert n > 25 and len(written["lm-pieces"]) >= 2
    assert all(table.count() <= 1.5 * 5 * n for table in written["lm-pieces"] + written["lm-answers"])


def test_counts_beyond_32_bits():
    for a in ([], [0, 5, (1 << 32) - 1], [1 << 32, 3, 1 << 50]):
        assert lm._from_planes(lm._planes(np.array(a, dtype=np.int64))).tolist() == a


def test_model_score_equals_formula(docs, cases):
    """The score is that of the interpolation formula with the learned weights."""
    tokens = [(i, words_of(t or "", "space") + [None]) for i, t in cases]
    train = [ws for i, ws in tokens if role(i) != 2]
    c = Counter(w for ws in train for w in ws)
    pairs = Counter((a, b) for ws in train for a, b in zip([None] + ws, ws))
    n, v = sum(c.values()), len(c)
    part = [ws for i, ws in tokens if role(i) == 4]
    cs = Counter(w for ws in part for w in ws)
    ps = Counter((a, b) for ws in part for a, b in zip([None] + ws, ws))
    events = Counter()
    side = int(-lm.FLOOR * lm.BINS) + 2
    bin_ = lambda p: 0 if p <= 0 else int(np.clip(np.rint((math.log10(p) - lm.FLOOR) * lm.BINS), 0, side - 2)) + 1
    bucket = lambda k: min(int(math.log2(k + 1)), lm.CONTEXT_BUCKETS - 1)
    for ws in part:
        for a, b in zip([None] + ws, ws):
            left, word = c[a] - cs[a], (c[b] - cs[b]) / (n - sum(cs.values()))
            pair = (pairs[a, b] - ps[a, b]) / left if left else word
            events[(bucket(left) * side + bin_(pair)) * side + bin_(word)] += 1
    cells = np.array(sorted(events), dtype=np.int64)
    w = lm.learn_weights(cells, np.array([events[x] for x in cells.tolist()], dtype=float), v)
    assert np.allclose(w.sum(axis=1), 1)
    got = {r.doc_id: r.score for r in lm.score_documents(docs(cases)).collect()}
    for i, ws in tokens:
        score = 0.0
        for a, b in zip([None] + ws, ws):
            k = w[bucket(c[a])]
            word = c[b] / n
            score += math.log10(k[0] / (v + 1) + k[1] * word + k[2] * (pairs[a, b] / c[a] if c[a] else word))
        assert got[i] == pytest.approx(score, rel=1e-9)


def test_weights_follow_the_evidence():
    side = int(-lm.FLOOR * lm.BINS) + 2
    at = lambda b, pair, word: (b * side + pair) * side + word
    cells = np.array([at(1, 0, 500), at(5, 590, 300)])
    w = lm.learn_weights(cells, np.array([1e6, 1e6]), 1000)
    assert w[1, 1] > 0.9 and w[5, 2] > 0.9


def test_empty_and_untrained(docs):
    assert lm.score_documents(docs([])).collect() == []
    from pyspark.sql import functions as F

    got = lm.score_documents(docs([(1, "a b")]), held_out=F.lit(True)).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(True, 3, 0, 0, 0.0)]


def test_equal_chunks_of_two_tasks(spark, cases):
    """A table and its repeat in two tasks: their equal chunks are counted and scored each."""
    twice = spark.createDataFrame(spark.sparkContext.parallelize(cases * 2, 2), "doc_id long, text string")
    got = lm.score_documents(twice).collect()
    tokens = [(i, words_of(t or "", "space") + [None]) for i, t in cases]
    c = Counter(w for i, ws in tokens * 2 if role(i) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr)
    want = sorted(((i, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                   for i, ws in tokens * 2), key=repr)
    assert have == want
    once = Counter((r.doc_id, round(r.score, 9)) for r in got)
    assert all(k % 2 == 0 for k in once.values())
