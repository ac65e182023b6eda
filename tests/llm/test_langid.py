"""Nearest-centroid language identification."""

import random

import numpy as np
import pytest

from cinerank.llm import langid

SYLLABLES = {"aa": ["ka", "mo", "ri", "ta"], "bb": ["sch", "ein", "ung", "ver"], "cc": ["çé", "aux", "ière", "où"]}


def speak(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(12)
    rows = [(i, speak(lang, rng, rng.randint(4, 60)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 ... !!", None), (1003, "é", None), (1004, "KA MO " * 30000, None),
             (1005, speak("bb", rng, 30), None), (1005, speak("bb", rng, 30), None), (None, speak("cc", rng, 30), "cc")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_predicts_and_marks_unknown(spark, table):
    model = langid.train(table.filter("doc_id % 5 <> 1 or doc_id is null"))
    from pyspark.sql import functions as F

    rows = langid.identify(table.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == table.count()
    got = {r.doc_id: r for r in rows}
    lang = {r.doc_id: r.lang for r in table.collect()}
    known = [i for i in range(180)]
    assert np.mean([got[i].lang_pred == lang[i] for i in known]) > 0.97
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[1003].lang_pred in SYLLABLES and got[1004].lang_pred == "aa" and got[1005].lang_pred == "bb"
    assert got[None].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in rows)


def test_rejects_by_distance(spark, table):
    model = langid.train(table)
    far = spark.createDataFrame([(1, "xyz qqq www jjj zzz")], "doc_id long, text string")
    r = langid.identify(far, model).first()
    assert r.rejected and r.lang_pred in SYLLABLES


def test_untrained_and_empty(spark, table):
    none = table.filter("false")
    model = langid.train(none)
    assert langid.identify(none, model).collect() == []
    assert {r.lang_pred for r in langid.identify(table, model).collect()} == {"und"}


def test_features_of_long_text_equal_pieces():
    t = ("abc def " * 300_000).encode()
    x = langid.features([t, b"abc"])
    assert x.shape == (2, langid.DIM) and x[0].max() > x[1].max() > 0
    assert len(np.flatnonzero(x[0])) < 40
