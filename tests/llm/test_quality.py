"""Weak labels, their EM, and the scorer."""

import random

import numpy as np
import pytest

from cinerank.llm import quality as Q
from tests.llm.conftest import prose


def sentence(rng, n):
    return "\n".join(prose(rng, max(1, n // 3)).capitalize() + "." for _ in range(3))


@pytest.fixture(scope="module")
def table():
    rng = random.Random(18)
    rows, good, toxic = [], {}, {}
    for i in range(400):
        kind = rng.choice(["good"] * 6 + ["shout", "stutter", "symbols", "toxic"])
        t = sentence(rng, rng.randint(40, 150))
        if kind == "shout":
            t = t.upper().replace(" ", "!! ")
        elif kind == "stutter":
            t = " ".join(w for w in t.split()[:20] for _ in range(15))
        elif kind == "symbols":
            t = t.replace(" ", " | ")
        elif kind == "toxic":
            t = t.replace(" the ", " idiot ").replace(" of ", " qwqw%s " % rng.choice("abc")) + " moron qwqwx."
        good[i], toxic[i] = kind in ("good", "toxic"), kind == "toxic"
        rows.append((i, t))
    return rows, good, toxic


def test_separates_junk_and_toxic(spark, docs, table):
    rows, good, toxic = table
    labels = spark.createDataFrame([(i, int(good[i]), int(toxic[i])) for i in range(0, 400, 2)],
                                   "doc_id long, quality int, toxic int")
    df = docs(rows, extra=True)
    model = Q.train(df, labels)
    got = {r.doc_id: r for r in Q.classify(df, model).collect()}
    clean = [i for i in good if good[i] and not toxic[i]]
    rest = [i for i in good if i not in set(clean)]
    assert np.mean([got[i].kept for i in clean]) > 0.97
    assert np.mean([not got[i].kept for i in rest]) > 0.95
    assert any(s.startswith("qwqw") for x in model.lexicons.lists for s in x)
    kept = Q.keep_good(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept}


def test_edge_rows(spark, docs, table):
    rows = table[0] + [(1000, None), (1001, ""), (1002, " \n "), (1003, "Good."), (1003, "Good."), (None, "A fine line."),
                       (1004, "A fine long line here.\n" * 5000)]
    df = docs(rows)
    model = Q.train(df)  # without labels: fixed lists only
    got = Q.classify(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    twice = [r.score for r in got if r.doc_id == 1003]
    assert len(twice) == 2 and twice[0] == twice[1]
    votes = {r.doc_id: r.votes for r in got}
    assert votes[1000] == votes[1001] == votes[1002]
    labels = spark.createDataFrame([(None, None, None), (1, 1, None), (2, 1, 0), (2, 1, 0), (9999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    assert Q.train(df, labels).lexicons.lists == (frozenset(),) * 3


def test_variety_is_judged_by_one_rule_at_every_length():
    """Forty words in any order are poor, a text that keeps bringing new ones is not, whatever the length."""
    rng = random.Random(23)
    at = Q.STYLE.index("variety")
    few = [f"w{i}" for i in range(40)]
    for n in (500, 3000, 19_000, 30_000):
        poor = [rng.choice(few) for _ in range(n)]
        rich = [f"r{i // 1000}x{rng.randrange(1500)}" for i in range(n)]  # distinct words of the whole text: fewer
        assert Q.style_votes(" ".join(poor).encode(), poor)[at] == -1
        assert Q.style_votes(" ".join(rich).encode(), rich)[at] == 1
    text = [rng.choice(few[:5] + [f"n{i}" for i in range(2500)]) for _ in range(15_000)]  # share of the whole: 0.17
    assert Q.style_votes(" ".join(text).encode(), text)[at] == 1


def test_empty_table(spark, docs):
    df = docs([])
    model = Q.train(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert Q.classify(df, model).collect() == [] and Q.keep_good(df, model).collect() == []


def test_em_finds_accuracies():
    """Votes drawn from known accuracies: EM recovers them and the class without labels."""
    rng = np.random.default_rng(19)
    bad = rng.random(20_000) < 0.2
    true = np.array([[0.9, 0.05], [0.7, 0.02], [0.6, 0.1], [0.8, 0.03]])
    p = np.where(bad[:, None], true[:, 0], true[:, 1])
    votes = np.where(rng.random(p.shape) < 0.15, 0, np.where(rng.random(p.shape) < p, -1, 1))
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    model = Q.LabelModel.fit(patterns, n.astype(float))
    assert np.allclose(model.bad, true, atol=0.05) and abs(model.share - 0.2) < 0.02
    assert ((model.posterior(votes) > 0.5) == bad).mean() > 0.95


def test_scorer_learns_a_linear_rule():
    rng = np.random.default_rng(20)
    rows = [np.unique(rng.integers(0, 300, 12)) for _ in range(8000)]
    target = np.array([float((r < 30).sum() >= 1) for r in rows])
    scorer = Q.Scorer().fit(rows[:7000], target[:7000])
    assert ((scorer.probability(rows[7000:]) > 0.5) == (target[7000:] > 0.5)).mean() > 0.95
