"""Suffix-array decontamination against a plain scan."""

import random
import tracemalloc

import numpy as np
import pytest

from cinerank.llm import decontaminate as D
from tests.llm.conftest import prose
from tests.llm.test_text import words_of


def brute(rows, items, window=13):
    out = []
    wins = {}
    for name, t in items:
        w = words_of(t or "", "alnum")
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(str(name))
    for doc, t in rows:
        w = words_of(t or "", "alnum")
        hit, names = set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    names |= wins[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), tuple(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randint(14, 40))) for i in range(12)] + [
        (100, "Three short words"), (101, ""), (102, None), (103, "!!!"), (3, "again one more text of item three " * 3)]
    rows = [(i, prose(rng, rng.randint(0, 200))) for i in range(40)]
    for k in range(20):  # planted passages, also cut, upper-cased, repeated and overlapping
        w = items[k % 12][1].split()
        a = rng.randint(0, max(0, len(w) - 14))
        part = " ".join(w[a:a + rng.choice([12, 13, 14, 30])]).upper()
        rows.append((1000 + k, prose(rng, rng.randint(0, 60)) + " " + part + ", " + part + " " + prose(rng, 20)))
    rows += [(2000, None), (2001, ""), (2002, items[0][1]), (2002, items[0][1]), (2003, "x three SHORT words y"),
             (None, items[1][1]), (2004, ("filler " * 3000) + items[2][1])]
    return rows, items


@pytest.mark.parametrize("limit", [16 << 20, 300])
def test_equals_brute_force(spark, docs, cases, limit):
    rows, items = cases
    got = D.contamination(docs(rows, extra=True), spark.createDataFrame(items, "item_id long, text string"),
                          max_item_bytes=limit).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got], key=repr) \
        == brute(rows, items)
    for r in got:  # spans cover exactly the hit words
        assert sum(e - s for s, e in zip(r.spans[::2], r.spans[1::2])) == r.n_hit


@pytest.mark.parametrize("limit", [16 << 20, 300])
def test_remove_keeps_clean_rows(spark, docs, cases, limit):
    rows, items = cases
    df = docs(rows, extra=True)
    kept = D.remove_contaminated(df, spark.createDataFrame(items, "item_id long, text string"), max_item_bytes=limit)
    assert kept.columns == df.columns
    bad = {(i, n, h) for i, n, h, _, c in brute(rows, items) if c}
    expected = [r for r in rows if not any(b[0] == r[0] and b[1] == len(words_of(r[1] or "", "alnum")) for b in bad)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_longest_match_and_place(spark, docs):
    item = " ".join(f"w{i}" for i in range(30))
    rows = [(1, "a b " + " ".join(f"w{i}" for i in range(5, 25)) + " c"), (2, "w0 w1 w2")]
    got = {r.doc_id: r for r in D.contamination(docs(rows), spark.createDataFrame([(7, item)], "item_id long, text string"))
           .collect()}
    assert (got[1].longest_match, got[1].longest_start, got[1].spans) == (20, 2, [2, 22])
    assert (got[2].longest_match, got[2].longest_start) == (0, None)


def test_long_items_take_memory_by_their_words():
    """An item of 6,000 words has 18 million words in its suffixes (144 MB a copy)."""
    text = " ".join(f"w{i}" for i in range(6000)).encode()
    tracemalloc.start()
    tests = D.TestSuffixes(["a", "b"], [text, b"short one"], 13)
    rows = D._shard_rows([0, 0], [1, 2], [b"x " + text, b"a w9 short one"], tests)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.column("longest_match").to_pylist() == [6000, 2] and rows.column("n_hit").to_pylist() == [6000, 2]
    assert rows.column("items").to_pylist() == [["a"], ["b"]]
    assert peak < 32 << 20


def test_longest_match_by_brute_force():
    """Small alphabets: repeated windows, items that share passages, matches that begin and end anywhere."""
    rng = random.Random(8)
    for window in (1, 3, 5):
        for _ in range(60):
            word = lambda n: [rng.choice("ab") for _ in range(rng.randint(0, n))]  # noqa: B023, E731
            items, texts = [word(14) for _ in range(4)], [word(30) for _ in range(5)]
            tests = D.TestSuffixes(list("wxyz"), [" ".join(x).encode() for x in items], window)
            got = D._shard_rows([0] * 5, [0] * 5, [" ".join(x).encode() for x in texts], tests).to_pylist()
            for text, r in zip(texts, got):
                best, hit, names = (0, None), set(), set()
                for name, x in zip("wxyz", items):
                    least = min(window, len(x))
                    for s in range(len(x) - least + 1 if x else 0):
                        for p in range(len(text)):
                            n = 0
                            while n < min(len(x) - s, len(text) - p) and x[s + n] == text[p + n]:
                                n += 1
                            if n >= least:
                                hit |= set(range(p, p + least))
                                names.add(name)
                                if n > best[0] or (n == best[0] and p < best[1]):
                                    best = (n, p)
                assert (r["longest_match"], r["longest_start"], r["n_hit"], r["items"]) == (*best, len(hit), sorted(names))


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(docs([]), none).collect() == []
    got = D.contamination(docs([(1, "a b")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]
    assert D.remove_contaminated(docs([(1, "a b")]), none).count() == 1


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(2)
    words = rng.integers(1, 4, 400).astype(np.uint64)
    words[[50, 51, 399]] = 0
    order = D.suffix_array(words, 16)
    padded = words.tolist() + [0] * 16

    def key(p):
        out = []
        for x in padded[p:p + 16]:
            out.append(x)
            if x == 0:
                break
        return out

    keys = [key(p) for p in order.tolist()]
    assert keys == sorted(keys)
